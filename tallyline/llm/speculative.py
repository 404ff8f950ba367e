"""Pair-merge encoding and decoding by speculation and verification.

A text is split into words as the tokenizer does it: composed, lower-cased, cut by its
pattern, each word written in the byte alphabet with an end mark. For the words that a
slice of texts needs and the worker has not met, greedy longest-match proposes tokens.
A proposal is the true encoding exactly if every token is the encoding of its own text
and every two neighbours are the encoding of their concatenation; so all neighbouring
pairs of all proposals are looked up at once in a sorted table of judged pairs, pairs
not yet judged are merged exactly once, and only words with a failing pair undergo
exact merging.

Special tokens inside a text are recognised before anything else, as the library does.
NULL and empty texts have no tokens and decode to the empty string. Very long texts
take memory in proportion to their own length. Rows are independent: repeated rows,
ties and extra columns change nothing.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import regex
from pyspark.sql import DataFrame

from tallyline.llm.texts import map_text

#: Words kept by a worker; a full cache is set aside and its words are taken back as they occur.
CACHED_WORDS = 150_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabularies of this kind."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@dataclass(frozen=True)
class Model:
    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    pattern: str
    end: str

    @classmethod
    def load(cls, path: str) -> Model:
        """Reads a tokenizer file on the driver."""
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        split = whole["pre_tokenizer"]["pretokenizers"][0]
        steps = [step["type"] for step in whole["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or not split["invert"] or whole["decoder"] is not None:
            raise ValueError(f"{path}: not a lower-casing word tokenizer")
        pairs = [tuple(pair) if isinstance(pair, list) else tuple(pair.split(" ")) for pair in model["merges"]]
        return cls(model["vocab"], {pair: k for k, pair in enumerate(pairs)},
                   {token["content"]: token["id"] for token in whole["added_tokens"]},
                   split["pattern"]["Regex"], model["end_of_word_suffix"] or "")


class Encoder(dict):
    """Word -> (number of tokens, their ids as text, their texts as text)."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.names = {i: token for token, i in model.ids.items()}
        self.words_of = regex.compile(model.pattern).findall
        self.letters = {b: ord(char) for b, char in enumerate(byte_alphabet())}
        self.longest = max(map(len, model.ids))
        self.specials = re.compile("|".join(map(re.escape, sorted(model.special, key=len, reverse=True)))) if model.special else None
        self.older: dict[str, tuple] = {}     # words of the cache before the last time it was full
        self.whole: dict[int, bool] = {}
        self.judged = np.zeros(0, np.int64)   # pairs, sorted
        self.verdict = np.zeros(0, bool)

    # -- splitting -----------------------------------------------------------
    def split(self, text: str) -> list[str]:
        """The words of a stretch without special tokens."""
        text = unicodedata.normalize("NFC", text)
        if not text.isascii():
            text = text.replace("Σ", "σ")  # lower case is taken character by character
        return self.words_of(text.lower())

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens; the latter are in ``model.special``."""
        if self.specials is None or not self.specials.search(text):
            return self.split(text)
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += self.split(text[at : found.start()])
            out.append(found.group())
            at = found.end()
        return out + self.split(text[at:])

    # -- exact merging ---------------------------------------------------------
    def merge(self, symbols: list[str]) -> list[str]:
        """Merges the best-ranked pair, the leftmost of equals, until none is left."""
        parts, rank, none = list(symbols), self.model.ranks.get, 1 << 60
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            parts[k] += parts.pop(k + 1)
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank((parts[k], parts[k + 1]), none)
            if k:
                ranks[k - 1] = rank((parts[k - 1], parts[k]), none)
        return parts

    def symbols(self, marked: str) -> list[str]:
        """Single characters, the last with the end mark if there is one."""
        end = self.model.end
        if not end or not marked.endswith(end) or marked == end:
            return list(marked)
        body = marked[: -len(end)]
        return [*body[:-1], body[-1] + end]

    # -- speculation -------------------------------------------------------------
    def propose(self, marked: str) -> list[int] | None:
        """Greedy longest match; None where no token fits."""
        ids, at, out = self.model.ids, 0, []
        stop = len(marked)
        inside = stop - len(self.model.end)   # a token may not end inside the end mark
        while at < stop:
            token = None
            if stop - at <= self.longest:
                token = ids.get(marked[at:])
            if token is not None:
                at = stop
            else:
                for size in range(min(self.longest, inside - at), 0, -1):
                    token = ids.get(marked[at : at + size])
                    if token is not None:
                        break
                else:
                    return None
                at += size
                if at == inside and self.model.end:
                    return None               # the end mark cannot stand alone
            out.append(token)
        return out

    def is_whole(self, token: int) -> bool:
        known = self.whole.get(token)
        if known is None:
            name = self.names[token]
            known = self.whole[token] = self.merge(self.symbols(name)) == [name]
        return known

    def judge(self, pairs: np.ndarray) -> np.ndarray:
        """For each pair (left * 2^32 + right) whether both tokens stay as they are side by side."""
        unique, back = np.unique(pairs, return_inverse=True)
        place = np.searchsorted(self.judged, unique)
        known = np.zeros(len(unique), bool)
        inside = place < len(self.judged)
        known[inside] = self.judged[place[inside]] == unique[inside]
        fresh = unique[~known]
        if len(fresh):
            new = np.fromiter((self.stay(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in fresh), bool, len(fresh))
            at = np.searchsorted(self.judged, fresh)
            self.judged = np.insert(self.judged, at, fresh)
            self.verdict = np.insert(self.verdict, at, new)
            place = np.searchsorted(self.judged, unique)
        return self.verdict[place][back]

    def stay(self, left: int, right: int) -> bool:
        if not (self.is_whole(left) and self.is_whole(right)):
            return False
        left, right = self.names[left], self.names[right]
        return self.merge([*left, *self.symbols(right)]) == [left, right]

    def learn(self, words: list[str]) -> None:
        """Encodes words that are not in the cache yet."""
        marked = [word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters) + self.model.end for word in words]
        proposals = [self.propose(word) for word in marked]
        sizes = np.fromiter((len(p) if p else 0 for p in proposals), np.int64, len(proposals))
        flat = np.fromiter((token for p in proposals if p for token in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(proposals)), sizes)
        good = sizes > 0
        same = owner[1:] == owner[:-1]
        bad = ~self.judge((flat[:-1] << 32 | flat[1:])[same])
        good[owner[1:][same][bad]] = False
        for k in np.flatnonzero(sizes == 1):
            good[k] = self.is_whole(proposals[k][0])
        ids, names = self.model.ids, self.names
        for k, word in enumerate(words):
            tokens = proposals[k] if good[k] else [ids[s] for s in self.merge(self.symbols(marked[k])) if s in ids]
            self[word] = (len(tokens), " ".join(map(str, tokens)), " ".join([names[t] for t in tokens]))

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of tokens, ids and decoded text of each text."""
        pieces = [self.pieces(text) for text in texts]
        if len(self) > CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        for token, i in self.model.special.items():
            self[token] = (1, str(i), token)
        new = []
        for word in set().union(*pieces) - self.keys():
            known = self.older.get(word)
            if known is None:
                new.append(word)
            else:
                self[word] = known
        self.learn(new)
        out = []
        for some in pieces:
            n, ids, names = zip(*map(self.__getitem__, some)) if some else ((), (), ())
            out.append((sum(n), " ".join(ids), " ".join(names)))
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library decodes where a tokenizer file names no decoder: token texts joined by spaces."""
        extra = {i: token for token, i in self.model.special.items()}
        return " ".join(self.names[i] if i in self.names else extra[i] for i in ids)


_ENCODERS: dict[int, Encoder] = {}


def encoder(model: Model, key: int) -> Encoder:
    """The worker's encoder for this model; its words stay for later tasks."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def _shared(docs: DataFrame, path: str):
    model = Model.load(path)
    return docs.sparkSession.sparkContext.broadcast(model), hash((tuple(model.ids), tuple(model.ranks)))


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with the token ids and the decoded text of each whole text: ids, decoded.

    ``path`` is a tokenizer file, read on the driver; the tasks get it in one broadcast of
    the size of that file.
    """
    shared, key = _shared(docs, path)

    def make():
        coder = encoder(shared.value, key)

        def work(texts):
            got = coder.encode([value or "" for value in texts.to_pylist()])
            return [np.fromstring(ids, np.int32, sep=" ") for _, ids, _ in got], [decoded for _, _, decoded in got]

        return work

    return map_text(docs, make, "ids array<int>, decoded string", keep, text)


def digest(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and the SHA-256 of the ids and of the decoded text."""
    shared, key = _shared(docs, path)

    def make():
        coder = encoder(shared.value, key)

        def work(texts):
            got = coder.encode([value or "" for value in texts.to_pylist()])
            return ([n for n, _, _ in got], [sha256(ids.encode()).hexdigest() for _, ids, _ in got],
                    [sha256(decoded.encode()).hexdigest() for _, _, decoded in got])

        return work

    return map_text(docs, make, "n_tokens long, ids_sha256 string, decoded_sha256 string", keep, text)
