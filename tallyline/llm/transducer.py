"""Token counts by a finite-state transducer compiled from a tokenizer's vocabulary.

The vocabulary is that of a pair-merging tokenizer with scores: of all neighbouring
symbols whose concatenation is a piece, the pair with the best score merges first, the
leftmost of equals; what is no piece becomes its UTF-8 bytes.

Two facts make counting a walk over states. A sequence of pieces is the result for its
text exactly if every two neighbours are the result for their own concatenation
("compatible"); so the last piece of every prefix is determined by the last pieces of
shorter prefixes. And no piece is longer than a known bound; so the last pieces of that
many prefixes, with their counts, are all that the next step needs. That tuple is a
state; a transition carries the change of the count. States are compiled when a text
first needs them and kept.

Chunks are composed by an associative operation (``Span``): between two characters
that never stand together inside a piece nothing merges, so a chunk is described by its
open beginning, the count of its closed middle and its open end, and two descriptions
join into one. ``scan`` composes any number of them pairwise, so a text may be cut
anywhere.

NULL and empty texts have no tokens. Very long texts take time in proportion to their
length. Rows are independent: repeated rows, ties and extra columns change nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.texts import map_text

SPACE = "▁"
#: Entries of the caches of a worker; full words are set aside and taken back as they occur, full states are dropped.
CACHED_WORDS, CACHED_STATES = 250_000, 200_000
#: Tokens beyond which a document counts as over the limit.
TOKEN_LIMIT = 4096


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that may come out of merging, with their scores."""

    scores: dict[str, float]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Reads a model file on the driver; special and byte pieces never come out of merging."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = (i for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
        return cls({model.id_to_piece(i): model.get_score(i) for i in plain})


@dataclass
class State:
    recent: str       # the last characters, as far as a piece that is not yet complete reaches back
    open: tuple       # (length, last piece before it, tokens since then) of each end of ``recent`` that begins a longer piece
    moves: dict = field(default_factory=dict)    # character -> (state, change of the count)


class Transducer:
    def __init__(self, vocabulary: Vocabulary):
        self.scores = vocabulary.scores
        self.reach = max(map(len, self.scores), default=1)
        self.pairs = {piece[k : k + 2] for piece in self.scores for k in range(len(piece) - 1)}
        self.prefixes = {piece[:k] for piece in self.scores for k in range(1, len(piece))}
        self.whole: dict[str, bool] = {}
        self.compatible: dict[tuple[str, str], bool] = {}
        self.reset()
        #: Line ends stand in no piece with another character in this vocabulary, so lines can be counted one by one.
        self.lines_apart = not any("\n" in pair for pair in self.pairs)
        #: A space mark never follows another character inside a piece.
        self.words_apart = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.pairs)

    def reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = State("", ((0, None, 0),))

    def merge(self, text: str) -> list[str]:
        """The plain procedure; used only on the concatenation of two pieces."""
        symbols, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = scores.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def is_whole(self, piece: str) -> bool:
        known = self.whole.get(piece)
        if known is None:
            known = self.whole[piece] = len(piece) == 1 or self.merge(piece) == [piece]
        return known

    def fits(self, left: str | None, right: str) -> bool:
        if left is None or left[-1] + right[0] not in self.pairs:
            return True
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= 4 * CACHED_STATES:
                self.compatible.clear()
            known = self.compatible[left, right] = self.merge(left + right) == [left, right]
        return known

    def tokens_of(self, piece: str) -> int:
        return 1 if piece in self.scores else len(piece.encode("utf-8", "surrogatepass"))

    def step(self, state: State, char: str) -> tuple[State, int]:
        """Compiles one transition."""
        text = state.recent + char
        for size, before, gone in state.open:  # longest first; the empty end is always there
            piece = text[-size - 1 :]
            if size and (piece not in self.scores or not self.is_whole(piece)):
                continue
            if self.fits(before, piece):
                break
        change = self.tokens_of(piece) - gone
        start = next((k for k in range(len(text)) if text[k:] in self.prefixes), len(text))
        recent = text[start:]
        ends = [(size + 1, before, gone + change) for size, before, gone in state.open
                if size + 1 <= len(recent) and text[-size - 1 :] in self.prefixes]
        key = (recent, (*ends, (0, piece, 0)))
        known = self.states.get(key)
        if known is None:
            if len(self.states) >= CACHED_STATES:
                self.reset()
            known = self.states[key] = State(*key)
        state.moves[char] = known, change
        return known, change

    def count(self, text: str) -> int:
        state, total = self.start, 0
        for char in text:
            move = state.moves.get(char) or self.step(state, char)
            state = move[0]
            total += move[1]
        return total


@dataclass(frozen=True)
class Span:
    """A chunk: its characters if nothing in it is settled, else its open ends and the tokens between."""

    head: str
    middle: int | None = None
    tail: str = ""


def describe(transducer: Transducer, chunk: str) -> Span:
    cuts = [k for k in range(1, len(chunk)) if chunk[k - 1 : k + 1] not in transducer.pairs]
    if not cuts:
        return Span(chunk)
    return Span(chunk[: cuts[0]], transducer.count(chunk[cuts[0] : cuts[-1]]), chunk[cuts[-1] :])


def join(transducer: Transducer, left: Span, right: Span) -> Span:
    """Associative: the description of the two chunks one after the other."""
    if left.middle is None and right.middle is None:
        return describe(transducer, left.head + right.head)
    if left.middle is None:
        first = describe(transducer, left.head + right.head)
        if first.middle is None:
            return Span(first.head, right.middle, right.tail)
        return Span(first.head, first.middle + transducer.count(first.tail) + right.middle, right.tail)
    if right.middle is None:
        last = describe(transducer, left.tail + right.head)
        if last.middle is None:
            return Span(left.head, left.middle, last.head)
        return Span(left.head, left.middle + transducer.count(last.head) + last.middle, last.tail)
    return Span(left.head, left.middle + transducer.count(left.tail + right.head) + right.middle, right.tail)


def scan(transducer: Transducer, spans: list[Span]) -> int:
    """The tokens of all chunks together, composed pairwise."""
    while len(spans) > 1:
        spans = [join(transducer, *spans[k : k + 2]) if k + 1 < len(spans) else spans[k] for k in range(0, len(spans), 2)]
    only = spans[0] if spans else Span("")
    return transducer.count(only.head) + (0 if only.middle is None else only.middle + transducer.count(only.tail))


class _Words(dict):
    """Counts of chunks that begin with ``mark``."""

    def __init__(self, transducer: Transducer, mark: str):
        super().__init__()
        self.transducer, self.mark = transducer, mark
        self.older: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        count = self.older.get(word)
        if count is None:
            count = self.transducer.count(self.mark + word)
        if len(word) < 64:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = count
        return count


class Counter:
    """Counts texts; the spaces of a text become marks and one mark is put in front."""

    def __init__(self, vocabulary: Vocabulary):
        self.transducer = Transducer(vocabulary)
        self.words, self.bare = _Words(self.transducer, SPACE), _Words(self.transducer, "")
        self.newline = self.transducer.count("\n")
        self.fast = self.transducer.lines_apart and self.transducer.words_apart

    def spaced(self, line: str, first: bool) -> int:
        """A line with neighbouring spaces, or of a vocabulary without settled word ends."""
        marked = SPACE * first + line.replace(" ", SPACE)
        return scan(self.transducer, [describe(self.transducer, chunk) for chunk in re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", marked)])

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if not self.fast:
            return self.spaced(text, True)
        lines = text.split("\n")
        total = (len(lines) - 1) * self.newline
        for k, line in enumerate(lines):
            parts = line.split(" ")
            if "" in parts[k > 0 :]:
                total += self.spaced(line, k == 0)
            elif k == 0:
                total += sum(map(self.words.__getitem__, parts))
            else:
                total += self.bare[parts[0]] + sum(map(self.words.__getitem__, parts[1:]))
        return total


_COUNTERS: dict[int, Counter] = {}


def counter(vocabulary: Vocabulary, key: int) -> Counter:
    """The worker's counter for this vocabulary; its states stay for later tasks."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(vocabulary)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, model: str, limit: int = TOKEN_LIMIT, keep: list[str] | None = None,
                 text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit of each whole text.

    ``model`` is the path of a model file, read on the driver; the pieces go to the tasks
    in one broadcast of the size of that file.
    """
    vocabulary = Vocabulary.load(model)
    key = hash(tuple(vocabulary.scores.items()))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        tokens = counter(shared.value, key)

        def work(texts):
            texts = [value or "" for value in texts.to_pylist()]
            counts = [tokens(value) for value in texts]
            return [len(value.encode()) for value in texts], counts, [n > limit for n in counts]

        return work

    return map_text(docs, make, "n_bytes long, n_tokens long, over_limit boolean", keep, text)


def over_limit(docs: DataFrame, model: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """The documents with more than ``limit`` tokens."""
    return count_tokens(docs, model, limit).where(F.col("over_limit"))
