"""The operators that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from tallyline.llm.collocations import LEAST, SHARE, TOP
from tallyline.llm.divergence import CHARS_FROM, CHARS_LIMIT, CLASSES, COMMON, WORDS_FROM, WORDS_LIMIT

SPACED_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
PLAIN_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')"""

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SPACED_WORDS} AS w FROM documents),
win AS (SELECT r, doc_id, p, array_to_string(w[p : p + 49], ' ') AS k
        FROM d, unnest(range(1, len(w) - 48)) AS u(p) WHERE len(w) >= 50),
firsts AS (SELECT k, min(doc_id) AS low FROM win GROUP BY k),
gone AS (SELECT DISTINCT r, q FROM win JOIN firsts USING (k), unnest(range(p, p + 50)) AS u(q) WHERE low < doc_id),
cut AS (SELECT r, list(q) AS qs FROM gone GROUP BY r),
kept AS (SELECT d.doc_id, len(w) AS n,
                CASE WHEN qs IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(qs, i)) END AS k
         FROM d LEFT JOIN cut USING (r))
SELECT doc_id, n AS n_words, n - len(k) AS n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""

OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS w FROM documents),
b AS (SELECT item_id, {PLAIN_WORDS} AS w FROM benchmark),
phrases AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + 9], ' ') AS k
            FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM phrases),
win AS (SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS k
        FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(p) WHERE len(w) >= n),
found AS (SELECT r, p, n, item_id FROM win JOIN phrases USING (n, k)),
hits AS (SELECT r, count(DISTINCT q) AS h FROM found, unnest(range(p, p + n)) AS u(q) GROUP BY r),
names AS (SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY r)
SELECT d.doc_id, len(w) AS n_words, coalesce(h, 0) AS n_hit, coalesce(names.n, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(h, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""


def _words(listed: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in listed) + "]"


_LISTS = ", ".join(f"('{name}', {_words(listed)})" for name, listed in COMMON.items())
_CLASS_COUNTS = ", ".join(f"length(regexp_replace(t, '{pattern}', '', 'g')) AS c_{name}" for name, pattern in CLASSES.items())
_CLASS_SUM = " + ".join(f"c_{name}" for name in CLASSES)
_CLASS_LIST = ", ".join(f"c_{name}" for name in CLASSES)


def _distance(p: str, q: str) -> str:
    """Of two lists of counts: the Jensen-Shannon distance of their shares."""
    part = lambda x, m: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / {m}) ELSE 0.0 END"  # noqa: E731
    share = lambda bins: f"list_transform({bins}, lambda x: CAST(x AS DOUBLE) / greatest(list_sum({bins}), 1))"  # noqa: E731
    pairs = f"list_zip({share(p)}, {share(q)})"
    half = "((z[1] + z[2]) / 2)"
    return f"sqrt(greatest(list_sum(list_transform({pairs}, lambda z: ({part('z[1]', half)}) / 2 + ({part('z[2]', half)}) / 2)), 0.0))"


OP8 = rf"""
WITH lists(language, listed) AS (VALUES {_LISTS}),
d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t, {SPACED_WORDS} AS w FROM documents),
win AS (SELECT r, p, array_to_string(w[p : p + 4], ' ') AS k FROM d, unnest(range(1, len(w) - 3)) AS u(p) WHERE len(w) >= 5),
twice AS (SELECT r, p FROM win QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
again AS (SELECT r, count(DISTINCT q) AS n FROM twice, unnest(range(p, p + 5)) AS u(q) GROUP BY r),
guess AS (SELECT r, max({{'n': len(list_filter(w, lambda x: list_contains(listed, lower(x)))), 'name': language}}).name AS language
          FROM d, lists WHERE lang IS NULL GROUP BY r),
counted AS (
    SELECT d.r, doc_id, coalesce(lang, guess.language) AS language, w, len(w) AS n_words, length(t) AS chars,
           coalesce(length(array_to_string(w, '')), 0) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           coalesce(again.n, 0) AS n_repeat_words, {_CLASS_COUNTS}
    FROM d LEFT JOIN again USING (r) LEFT JOIN guess USING (r)),
binned AS (
    SELECT c.*, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           [{_CLASS_LIST}, chars - word_chars, word_chars - ({_CLASS_SUM})] AS char_bins,
           list_transform(coalesce(listed, []), lambda x: len(list_filter(w, lambda y: lower(y) = x))) AS common
    FROM counted c LEFT JOIN lists USING (language)),
bins AS (SELECT *, list_append(common, n_words - coalesce(list_sum(common), 0)) AS word_bins FROM binned),
sums AS (
    SELECT language, list(s ORDER BY k) FILTER (kind = 'char') AS char_ref, list(s ORDER BY k) FILTER (kind = 'word') AS word_ref
    FROM (SELECT language, kind, k, sum(x) AS s FROM (
            SELECT language, 'char' AS kind, unnest(char_bins) AS x, unnest(range(len(char_bins))) AS k FROM bins WHERE NOT base_failed
            UNION ALL
            SELECT language, 'word', unnest(word_bins), unnest(range(len(word_bins))) FROM bins WHERE NOT base_failed)
          GROUP BY language, kind, k)
    GROUP BY language),
far AS (SELECT bins.*, CASE WHEN chars >= {CHARS_FROM} THEN {_distance('char_bins', 'char_ref')} ELSE 0 END AS cd,
               CASE WHEN n_words >= {WORDS_FROM} THEN {_distance('word_bins', 'word_ref')} ELSE 0 END AS wd
        FROM bins LEFT JOIN sums USING (language))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(cd, 0) > {CHARS_LIMIT} OR coalesce(wd, 0) > {WORDS_LIMIT}) AS kept
FROM far
"""

# A word of a text in lower case and its piece; phrases are lists of neighbouring words of one piece.
OP13 = rf"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS r, string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
    FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)),
lines AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS p FROM pieces)),
grams AS (
    SELECT lang, k AS size, w[i : i + k - 1] AS phrase
    FROM lines, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS u(i) WHERE len(w) >= k),
f AS (SELECT lang, size, phrase, count(*) AS c FROM grams GROUP BY lang, size, phrase HAVING count(*) >= {LEAST}),
n AS (SELECT lang, sum(len(w)) AS n FROM lines GROUP BY lang),
inside AS (
    SELECT lang, phrase[i : i + k - 1] AS phrase, max(c) AS c
    FROM f, unnest(range(2, size)) AS s(k), unnest(range(1, size - k + 2)) AS u(i) WHERE size > 2 GROUP BY 1, 2),
cuts AS (
    SELECT f.lang, f.phrase, f.c AS a, k, x.c AS l, y.c AS r, CAST(n AS HUGEINT) AS n,
           (CAST(1000 AS HUGEINT) * f.c * n) // (CAST(x.c AS HUGEINT) * y.c) AS score
    FROM f JOIN n USING (lang), unnest(range(1, size)) AS s(k)
    JOIN f AS x ON x.lang = f.lang AND x.phrase = f.phrase[1 : k] JOIN f AS y ON y.lang = f.lang AND y.phrase = f.phrase[k + 1 : f.size]
    WHERE f.size > 1),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
    SELECT worst.lang, array_to_string(worst.phrase, ' ') AS phrase, a, l, r, n, score
    FROM worst LEFT JOIN inside ON inside.lang = worst.lang AND inside.phrase = worst.phrase
    WHERE inside.c IS NULL OR 100 * inside.c < {SHARE} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= {TOP}
"""



def _least(*ways: str) -> str:
    """The cheapest way, of equals that with the least edits; ways that are NULL do not count."""
    return f"list_min([{', '.join(ways)}])"


def _more(way: str, cost: str, edit: str, line: str | None, when: str = "true") -> str:
    """A way with one more edit, and one more line of text unless it is None."""
    text = f"{way}.t" if line is None else f"{way}.t || CASE WHEN {way}.t = '' THEN '' ELSE chr(10) END || {line}"
    return f"CASE WHEN {way} IS NOT NULL AND {when} THEN {{'c': {way}.c + {cost}, 'k': {way}.k || '{edit}', 't': {text}}} END"


# Ways to have written nothing (e), up to a system message (s), a user (u), an assistant (a), before and after inserts.
_INSERTED_U = _least("u", *(_more(x, "3", "I", "'user:'") for x in "esa"))
_INSERTED_A = _least("a", _more("v", "3", "I", "'assistant:'"))
_KEPT = "role || ':' || text"
_STAYS = "fault NOT IN ('blank', 'duplicate')"
_EXTRA = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"


def _row(to: str, own: str | None, before: str, name: str | None) -> str:
    """Ways to stand in a state after a row: it is deleted, kept if its initial is ``own``, or given the role ``name``."""
    ways = [_more(to, "4", "D", None)]
    if own:
        ways += [_more(x, f"0 + {_EXTRA}", "K", _KEPT, f"{_STAYS} AND starts_with(role, '{own}')") for x in before]
    if name:
        ways += [_more(x, f"3 + {_EXTRA}", "R", f"'{name}:' || text", _STAYS) for x in before]
    return _least(*ways)


_NO_WAY = "CAST(NULL AS STRUCT(c BIGINT, k VARCHAR, t VARCHAR))"

OP12 = rf"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
coded AS (
    SELECT *, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(key, ''),
                  lambda b: [CAST(ord(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
              lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS code
    FROM keyed),
damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM coded, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copies(n) WHERE code <> 0),
groups AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations) d),
placed AS (
    SELECT g, turn, role, text, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i
    FROM damaged JOIN groups ON damaged.conv_id IS NOT DISTINCT FROM groups.conv_id),
lines AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE 'fine' END AS fault,
           lag(role) OVER (PARTITION BY g ORDER BY i) AS earlier
    FROM placed),
ways AS (
    SELECT g, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'k': '', 't': ''}} AS e, {_NO_WAY} AS s, {_NO_WAY} AS u, {_NO_WAY} AS a FROM groups
    UNION ALL
    SELECT g, i, {_row("e", None, "", None)}, {_row("s", "s", "e", None)}, {_row("v", "u", "esb", "user")}, {_row("b", "a", "v", "assistant")}
    FROM (SELECT *, {_INSERTED_A} AS b
          FROM (SELECT lines.g, lines.i, role, text, fault, e, s, u, a, {_INSERTED_U} AS v
                FROM ways JOIN lines ON lines.g = ways.g AND lines.i = ways.i + 1) x) y),
ends AS (SELECT g, {_least("e", "b")} AS best
         FROM (SELECT *, {_INSERTED_A} AS b FROM (SELECT *, {_INSERTED_U} AS v FROM ways QUALIFY i = max(i) OVER (PARTITION BY g)) x) y),
sums AS (
    SELECT g, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND left(earlier, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM lines GROUP BY g)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.k AS audit, sha256(best.t) AS repaired_sha256
FROM groups JOIN ends USING (g) LEFT JOIN sums USING (g)
"""

ORACLE: dict[str, str] = {
    "op2_recompression": OP2,
    "op7_positional_index": OP7,
    "op8_divergence": OP8,
    "op12_hirschberg_repair": OP12,
    "op13_trie_collocations": OP13,
}
