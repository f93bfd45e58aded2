"""Language of a text by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of one fixed public vocabulary. A word's probability in a language is the sum over
all its segmentations into pieces, by the forward algorithm; a text's is the product over its words. The
probabilities are learned by expectation maximisation: forward and backward sums give the expected count of every piece in
every distinct word of the training texts. Counts come from all training texts; what is broadcast is one row per piece. A language's counts are
mixed with a background that all languages share, at the fixed weight ``SHARED``, so a piece that no training text holds tells nothing about the
language, whatever amount of text each of them has. Words and pieces of any length take part: the lattice is linear in the word.

A text without a letter, empty or null, is ``und`` with score 0. If nothing can be learned every text is ``und``. The score is the
posterior of the language with equal priors, by the mean log probability of a word; of equal languages the first by name is taken. Rows that repeat an id are judged one by one.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.pieces import distinct
from pairloom.llm.words import blocks, utf8, words

ROUNDS = 3
SHARED = 0.05
REMEMBERED = 100_000  # runs of letters in each of the two generations a worker keeps
CELLS = 1 << 17  # words times places that are worked on at once
UNKNOWN = "und"

_MARK = "▁"  # fixed value: how the vocabulary writes the beginning of a word
_WORD = regex.compile(r"\p{L}+")
_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


@cache
def vocabulary(path: str) -> dict[str, int]:
    """Pieces of a sentencepiece model made of letters, in lower case, with or without the mark of a beginning."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).lower()
        if piece.removeprefix(_MARK).isalpha():
            pieces.setdefault(piece, len(pieces))
    return pieces


_STEP = np.uint64(0x9E3779B97F4A7C15)
_FILTER = 1 << 20


class _Table:
    """The vocabulary by the hashes of its pieces: sorted, with a bit for each, so that most places of a word are passed over at once."""

    def __init__(self, path: str) -> None:
        pieces = vocabulary(path)
        self.longest = max(map(len, pieces), default=1)
        hashes = np.zeros(len(pieces), np.uint64)
        for size in range(1, self.longest + 1):
            own = [i for p, i in pieces.items() if len(p) == size]
            letters = _letters([p for p in pieces if len(p) == size]).reshape(-1, size)
            total = np.zeros(len(own), np.uint64)
            for k in range(size):
                total = (total + letters[:, k]) * _STEP
            hashes[own] = total
        order = np.argsort(hashes)
        self.keys, self.number = hashes[order], order
        self.filter = np.zeros(_FILTER, bool)
        self.filter[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and the numbers of these."""
        likely = np.flatnonzero(self.filter[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[likely]), len(self.keys) - 1)
        right = self.keys[at] == hashes[likely]
        return likely[right], self.number[at[right]]


@cache
def _table(path: str) -> _Table:
    return _Table(path)


def _letters(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)


def _words_of(raw: bytes) -> list[str]:
    """The words in a run of letter bytes."""
    return [_MARK + word for word in _WORD.findall(raw.decode().lower())]


def _shares(texts: list[str]) -> Iterator[np.ndarray]:
    """Places in the list, dealt so that words of about the same length are worked on together and one share stays small."""
    size = np.array([len(t) for t in texts], np.int64)
    order, first = np.argsort(size, kind="stable"), 0
    while first < len(order):
        room = max(CELLS // (size[order[first]] + 1), 1)
        last = first + int(np.searchsorted(size[order[first : first + room]], 2 * size[order[first]], "right"))
        yield order[first : max(last, first + 1)]
        first = max(last, first + 1)


class Lattice:
    """All pieces in some words: where each begins and ends, and its number (one past the last for an unknown letter)."""

    def __init__(self, texts: list[str], path: str) -> None:
        table, letters = _table(path), _letters(texts)
        self.length = np.array([len(t) for t in texts], np.int64)
        word = np.repeat(np.arange(len(texts)), self.length)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        left = self.length[word] - place
        at, total = np.arange(len(letters)), np.zeros(len(letters), np.uint64)
        alone = np.ones(len(letters), bool)
        found: list[tuple[np.ndarray, ...]] = []
        for size in range(1, table.longest + 1):
            inside = left[at] >= size
            at, total = at[inside], total[inside]
            if not len(at):
                break
            total = (total + letters[at + size - 1]) * _STEP
            hit, number = table.find(total)
            begin = at[hit]
            if size == 1:
                alone[begin] = False
            found.append((place[begin] + size, word[begin], place[begin], number))
        rest = np.flatnonzero(alone)
        found.append((place[rest] + 1, word[rest], place[rest], np.full(len(rest), len(table.number))))
        self.arcs = np.stack([np.concatenate([f[k] for f in found]) for k in range(4)], axis=1)
        self.arcs = self.arcs[np.lexsort((self.arcs[:, 1], self.arcs[:, 0]))]
        self.steps = np.searchsorted(self.arcs[:, 0], np.arange(int(self.length.max(initial=0)) + 2))

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """Log of the sum over all segmentations of each beginning of each word: word x place x language."""
        alpha = np.full((len(self.length), len(self.steps), logs.shape[1]), -np.inf)
        alpha[:, 0] = 0
        for end in range(1, len(self.steps) - 1):
            self._add(alpha, self.arcs[self.steps[end] : self.steps[end + 1]], logs, to=0, source=2)
        return alpha

    def _add(self, table: np.ndarray, arcs: np.ndarray, logs: np.ndarray, to: int, source: int) -> None:
        if not len(arcs):
            return
        value = table[arcs[:, 1], arcs[:, source]] + logs[arcs[:, 3]]
        begin = np.flatnonzero(np.append(True, arcs[1:, 1] != arcs[:-1, 1]))  # arcs of one step come by word
        table[arcs[begin, 1], arcs[begin, to]] = np.logaddexp.reduceat(value, begin, axis=0)

    def totals(self, logs: np.ndarray) -> np.ndarray:
        return self.forward(logs)[np.arange(len(self.length)), self.length]

    def expected(self, logs: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
        """Expected uses of each piece by language; ``weight``: words x languages."""
        alpha = self.forward(logs)
        beta = np.full(alpha.shape, -np.inf)
        beta[np.arange(len(self.length)), self.length] = 0
        by_start = self.arcs[np.lexsort((self.arcs[:, 1], self.arcs[:, 2]))]
        at = np.searchsorted(by_start[:, 2], np.arange(len(self.steps) + 1))
        for start in range(len(self.steps) - 2, -1, -1):
            self._add(beta, by_start[at[start] : at[start + 1]], logs, to=2, source=0)
        end, word, start, piece = self.arcs.T
        share = np.exp(alpha[word, start] + logs[piece] + beta[word, end] - beta[word, 0])
        out = np.zeros((size, logs.shape[1]))
        for j in range(logs.shape[1]):
            out[:, j] = np.bincount(piece, weights=share[:, j] * weight[word, j], minlength=size)
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, lang -> the distinct words of each block and language, with counts."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        order = sorted(range(len(langs)), key=lambda k: langs[k])
        texts = batch.column(0).take(pa.array(order, pa.int64()))
        begin = 0
        while begin < len(order):
            lang = langs[order[begin]]
            until = begin
            while until < len(order) and langs[order[until]] == lang:
                until += 1
            data, offsets = utf8(texts.slice(begin, until - begin))
            for first, last in blocks(offsets):
                part = data[offsets[first] : offsets[last]]
                found, times = _runs(part, offsets[first : last + 1] - offsets[first])[:2]
                times = np.bincount(times, minlength=len(found))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array([f.decode().lower() for f in found], pa.string()), pa.array(times)], names=["lang", "word", "n"])
            begin = until


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct runs of letter bytes, which of them each run is, and at which run each text begins."""
    _, begin, until, at = words(data, offsets, _NOT_LETTERS, lower=True)
    if not len(begin):
        return [], np.zeros(0, np.int64), at
    length = until - begin
    ends = np.cumsum(length)
    packed = data[np.repeat(begin - (ends - length), length) + np.arange(int(ends[-1]))]
    packed = np.where((packed >= 65) & (packed <= 90), packed + 32, packed).astype(np.uint8)
    found, which = distinct(packed, ends - length)
    return found, which, at


def _expect(path: str, langs: list[str], logs: np.ndarray):
    """lang, word, n -> expected counts of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(logs.shape)
        number = {lang: j for j, lang in enumerate(langs)}
        for batch in batches:
            texts, own = [], []
            for lang, word, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for w in _words_of(word.encode()):
                    texts.append(w)
                    own.append((number[lang], n))
            for part in _shares(texts):
                lang, n = np.array([own[k] for k in part]).T
                table = np.zeros((len(part), len(langs)))
                table[np.arange(len(part)), lang] = n
                total += Lattice([texts[k] for k in part], path).expected(logs, table, len(total))
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

    return run


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Log probabilities: each language's shares, mixed with the background of all languages and of unseen pieces."""
    totals = counts.sum(axis=0, keepdims=True)
    share = np.divide(counts, totals, out=np.full(counts.shape, 1 / len(counts)), where=totals > 0)
    shared = (share.mean(axis=1, keepdims=True) + 1 / len(counts)) / 2
    return np.log((1 - SHARED) * share + SHARED * shared)


def train(texts: DataFrame, path: str, text_column: str = "text", lang_column: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of their pieces, learned from all rows with a language."""
    from pairloom.llm.stages import Stage

    rows = texts.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    counted = rows.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).mapInArrow(_count, "lang string, word string, n bigint")
    stage = Stage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = sorted(r[0] for r in stage.df.select("lang").distinct().collect())
    size = len(vocabulary(path)) + 1
    logs = np.full((size, max(len(langs), 1)), -np.log(size))
    for _ in range(ROUNDS if langs else 0):
        found = stage.df.mapInArrow(_expect(path, langs, logs), "piece bigint, lang bigint, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        counts = np.zeros(logs.shape)
        rows = found.toArrow()  # at most pieces x languages rows
        counts[rows["piece"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy()
        logs = smoothed(counts)
    stage.drop()
    return langs, logs


def _predict(path: str, langs: list[str], logs: np.ndarray):
    young: dict[bytes, np.ndarray] = {}
    old: dict[bytes, np.ndarray] = {}

    def totals(found: list[bytes]) -> np.ndarray:
        """Log probability of each run of letters by language; one more column counts its words."""
        nonlocal young, old
        if len(young) > REMEMBERED:
            young, old = {}, young
        out = np.zeros((len(found), logs.shape[1] + 1))
        texts, owner = [], []
        for k, f in enumerate(found):
            known = young.get(f)
            known = old.get(f) if known is None else known
            if known is None:
                split = _words_of(f)
                texts += split
                owner += [k] * len(split)
                out[k, -1] = len(split)
            else:
                young[f] = out[k] = known
        own = np.array(owner, np.int64)
        for part in _shares(texts):
            np.add.at(out[:, :-1], own[part], Lattice([texts[k] for k in part], path).totals(logs))
        for k in dict.fromkeys(owner):
            young[found[k]] = out[k].copy()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, scores = [], []
            data, offsets = utf8(batch.column(1))
            for first, last in blocks(offsets):
                part = data[offsets[first] : offsets[last]]
                found, which, at = _runs(part, offsets[first : last + 1] - offsets[first])
                value = totals(found) if found else np.zeros((0, logs.shape[1] + 1))
                for k in range(last - first):
                    total = value[which[at[k] : at[k + 1]]].sum(axis=0) if at[k + 1] > at[k] else np.zeros(logs.shape[1] + 1)
                    if not total[-1] or not langs:
                        named.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    mean = total[:-1] / total[-1]
                    best = int(mean.argmax())
                    named.append(langs[best])
                    scores.append(float(1 / np.exp(mean - mean[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(named, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang", "score"])

    return run


def identify(docs: DataFrame, training: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Per row of ``docs``: id, lang, score. ``training`` holds the texts and languages to learn from, and no others."""
    langs, logs = train(training, path, text_column, lang_column)
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(_predict(path, langs, logs), "id bigint, lang string, score double")
