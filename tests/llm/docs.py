"""Small document tables with everything that is awkward."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, key string"


def texts(count=60, seed=5):
    rng = random.Random(seed)
    words = ["the", "of", "and", "idea", "stone", "river", "Öl", "der", "und", "zu", "que", "naïve", "x", "42", "a.b", "don't"]
    line = lambda n: " ".join(rng.choice(words) + (str(rng.randint(0, 60)) if rng.random() < 0.5 else "") for _ in range(n))
    passage, common = line(80), line(55)
    out = [line(rng.randint(1, 200)) for _ in range(count)]
    for k in range(0, count, 4):
        out[k] = f"{line(rng.randint(0, 30))}\n{passage} {line(rng.randint(0, 30))}"
    for k in range(1, count, 5):
        out[k] = out[1] if k % 2 else f"{common} {line(3)} {common}"
    out[3] = "again " * 170
    out[7] = "one two three " * 60
    out[9] = line(6000)
    out += ["", " \t\n", "word", "  spaced   out   text\x0b ", "A" * 5000, "é" * 3000 + " " + "\U0001f642" * 50, "?!? ... ---",
            "mail a.b@example.com or +1 (314) 555-4198, 10.0.0.1, 4111 1111 1111 1111", None, None]
    return out


def rows(count=60, seed=5):
    made = [(k * 3 + 1, t, ["en", "de", None, "fr"][k % 4], "s", len(t or ""), "x", None) for k, t in enumerate(texts(count, seed))]
    made += [made[2], made[5], (None, made[4][1], "en", "s", 1, None, None), (None, None, None, None, None, None, None)]
    return made


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(3)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def same(got, expected):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)
