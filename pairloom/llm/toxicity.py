"""Toxicity of texts whose spelling may be disguised: a noisy channel restores words, learned word beginnings score them.

Channel. A disguised token is a sequence of signs: look-alike digits and symbols for letters (``LOOKS_LIKE``), letters repeated,
signs or spaces put between letters. Each token is a lattice in which a sign stands for one of its letters, repeats the letter before,
or stands for nothing; a character bigram model counted over all documents weighs the paths, and Viterbi decoding takes
the best. Only tokens that look disguised are decoded: signs beside or between letters, a letter three times running, a letter twice that the
model would not leave so, or three and more single signs in a row. Look-alikes at an end are read both ways, as letters and as the decoder likes.
A row of single signs is read from each of its signs on, and each beginning of what is read counts as a word.

Scores. A feature is a word or its first 4, 5 or 6 bytes. Its evidence is the number of different left neighbours it has in toxic and in
clean texts of the training sample, or the number of these texts, whichever is less (both counted exactly): so neither
many copies of one text nor one long text make evidence. A text's score is the strongest feature's score, which nears 1 only
for features with much evidence in toxic texts and little in clean ones.

Labels are used from the rows that ``train`` selects, ``SAMPLE`` rows of each label at most on average, chosen by a hash of the
id; character counts cover all documents. Null, empty and letterless texts have no features and get the lowest score
of all; so does every text if there are no labels. Rows that repeat an id are scored one by one, labels that
repeat an id count once. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import ArrowUDFType

from pairloom.llm.stages import carried
from pairloom.llm.words import blocks, mix, utf8, words

SAMPLE = 20_000
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
STATES = 28  # a boundary, a to z, any other letter
LONGEST = 64  # signs decoded together
REMEMBERED = 20_000  # decoded parts, in each of two generations

# Signs and the letters they are used for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "#": "h", "%": "x", "&": "e",
}

_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
_SIGNS = "".join(regex.escape(c) for c in LOOKS_LIKE)
# Single signs with one separator between each two; as matches may overlap, a run is also read from each of its later signs on.
_RUN = rf"(?<![\p{{L}}\d])(?:[\p{{L}}{_SIGNS}][ .\-_*]){{2,{LONGEST // 2 - 1}}}[\p{{L}}{_SIGNS}](?![\p{{L}}\d])"


@cache
def _disguised(rare: str = "") -> regex.Pattern:
    """Runs of single signs, and tokens with a sign beside or between letters, a letter three times, or one of ``rare`` twice."""
    twice = rf"|([{rare}])\3" if rare else ""
    return regex.compile(rf"(?P<run>{_RUN})|(?<!\S)\S*?(?:\p{{L}}[{_SIGNS}]|[{_SIGNS}]\p{{L}}|\p{{L}}[^\p{{L}}\s]+\p{{L}}|(\p{{L}})\2\2{twice})\S*+", regex.IGNORECASE)


_DISGUISED = _disguised()
_PUNCTUATION = "()[]{}<>!?.,;:'\"\u00ab\u00bb\u201c\u201d\u201e\u2018\u2019\u2026"
_AT_AN_END = regex.compile(rf"^\P{{L}}*[{_SIGNS}]|[{_SIGNS}]\P{{L}}*$")
_COST = {"itself": 0.0, "looks": -1.2, "repeat": -0.5, "repeat once": -5.0, "separator": -0.3, "at an end": -1.0, "nothing": -8.0, "letter lost": -40.0, "boundary": -5.0}


def _class_of() -> np.ndarray:
    """State of each byte: letters by themselves, the first byte of any other character as one class, the rest boundaries."""
    state = np.zeros(256, np.int64)
    for b in range(26):
        state[65 + b] = state[97 + b] = b + 1
    state[0xC0:] = STATES - 1
    state[0x80:0xC0] = -1  # inside a character
    return state


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> counts of neighbouring states."""
    state, total = _class_of(), np.zeros(STATES * STATES, np.int64)
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for first, last in blocks(offsets):
            for at in range(int(offsets[first]), int(offsets[last]), 1 << 20):
                own = state[data[at : min(at + (1 << 20) + 1, int(offsets[last]))]]
                own = own[own >= 0]
                total += np.bincount(own[:-1] * STATES + own[1:], minlength=STATES * STATES)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(STATES * STATES)), pa.array(total)], names=["pair", "n"])


def character_model(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Log probability of a state after a state, from all documents."""
    counts = docs.select(F.col(text_column).alias("text")).mapInArrow(_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.full(STATES * STATES, 0.5)
    for pair, n in counts.collect():  # STATES * STATES rows
        table[pair] += n
    table = table.reshape(STATES, STATES)
    table[0, 0] = 0.5
    return np.log(table / table.sum(axis=1, keepdims=True))


@cache
def _emissions() -> dict[str, np.ndarray]:
    """For each sign the cost of every letter it may stand for."""
    out = {}
    for b in range(26):
        row = np.full(STATES, -np.inf)
        row[b + 1] = _COST["itself"]
        out[chr(97 + b)] = row
    for sign, letters in LOOKS_LIKE.items():
        row = np.full(STATES, -np.inf)
        for c in letters:
            row[ord(c) - 96] = _COST["looks"]
        out[sign] = row
    gap = np.full(STATES, -np.inf)
    gap[0] = _COST["boundary"]
    out[" "] = gap
    return out


def restore(tokens: list[str], model: np.ndarray, ends: bool = False) -> list[str]:
    """The likeliest words behind each token, joined by spaces; tokens of one length are decoded together. ``ends``: signs at an end are letters."""
    out: list[str] = [""] * len(tokens)
    by_length: dict[int, list[int]] = {}
    for k, token in enumerate(tokens):
        by_length.setdefault(len(token), []).append(k)
    other = np.full(STATES, -np.inf)
    other[STATES - 1] = 0.0
    none = np.full(STATES, -np.inf)
    emissions = _emissions()
    for length, members in by_length.items():
        for at in range(0, len(members), 4096):
            part = members[at : at + 4096]
            rows = np.arange(len(part))
            best = np.full((len(part), STATES), -np.inf)
            best[:, 0] = 0
            back = np.zeros((length, len(part), STATES), np.int8)  # state before, or -1: the sign stands for nothing
            for p in range(length):
                signs = [tokens[k][p] for k in part]
                emit = np.stack([emissions.get(s, other if s.isalpha() else none) for s in signs])
                skip = np.array([_skip(tokens[k], p, ends) for k in part])[:, None]
                through = best[:, :, None] + model[None]
                source = through.argmax(axis=1)
                step = np.take_along_axis(through, source[:, None, :], axis=1)[:, 0] + emit
                stay = best + skip
                back[p] = np.where(stay > step, -1, source)
                best = np.maximum(stay, step)
            state = (best + model[:, 0][None]).argmax(axis=1)
            made = [[] for _ in part]
            for p in range(length - 1, -1, -1):
                source = back[p, rows, state]
                for r in np.flatnonzero(source >= 0):
                    s = int(state[r])
                    made[r].append(" " if s == 0 else chr(96 + s) if s < STATES - 1 else tokens[part[r]][p])
                state = np.where(source >= 0, source, state)
            for r, k in enumerate(part):
                out[k] = "".join(reversed(made[r]))
    return out


def _skip(token: str, p: int, ends: bool = False) -> float:
    """Cost of a sign that stands for nothing."""
    sign = token[p]
    if sign.isalpha():
        if p and token[p - 1] == sign:
            again = (p > 1 and token[p - 2] == sign) or (p + 1 < len(token) and token[p + 1] == sign)
            return _COST["repeat"] if again else _COST["repeat once"]
        return _COST["letter lost"]
    if sign not in LOOKS_LIKE:
        return _COST["separator"]
    outside = not ends and (not any(c.isalpha() for c in token[p:]) or not any(c.isalpha() for c in token[:p]))
    return _COST["at an end"] if outside else _COST["nothing"]


def _rare_twice(model: np.ndarray) -> str:
    """Letters that the decoder would not leave doubled."""
    return "".join(chr(96 + c) for c in range(1, STATES - 1) if model[c, c] < _COST["repeat once"])


_LETTER, _SPACE, _DIGIT, _SIGN, _SEPARATOR, _KNOWN = (1 << k for k in range(6))


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kinds and lower case of all characters, filled in as they are met."""
    return np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)


def _kinds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each code point."""
    kinds, lower = _characters()
    for point in np.unique(points[kinds[points] == 0]).tolist():
        c = chr(point)
        tests = ((_LETTER, regex.match(r"\p{L}", c)), (_SPACE, regex.match(r"\s", c)), (_DIGIT, regex.match(r"\d", c)), (_SIGN, c in LOOKS_LIKE), (_SEPARATOR, c in " .-_*"))
        kinds[point] = _KNOWN | sum(bit for bit, holds in tests if holds)
        lower[point] = ord(c.lower()) if len(c.lower()) == 1 else point
    return kinds[points], lower[points]


@cache
def _run_pattern() -> regex.Pattern:
    return regex.compile(_RUN, regex.IGNORECASE)


def spots(text: str, rare: str) -> list[tuple[int, int, bool]]:
    """Begin and end of what ``_disguised(rare)`` matches, overlaps included, and whether it is a run: found for all characters at once."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < 2:
        return []
    kind, lower = _kinds(points)
    letter, space, sign = (kind & bit != 0 for bit in (_LETTER, _SPACE, _SIGN))
    hits = [np.flatnonzero(letter[:-1] & sign[1:] | sign[:-1] & letter[1:])]
    again = letter[1:] & (lower[1:] == lower[:-1])
    hits.append(np.flatnonzero(again[1:] & again[:-1]))
    hits.append(np.flatnonzero(again & np.isin(lower[1:], [ord(c) for c in rare])))
    at = np.flatnonzero(letter)
    blanks = np.cumsum(space, dtype=np.int32)
    hits.append(at[:-1][(np.diff(at) > 1) & (blanks[at[1:]] == blanks[at[:-1]])])
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    token = np.unique(np.searchsorted(begin, np.concatenate(hits), "right") - 1)
    found = {b: (e, False) for b, e in zip(begin[token].tolist(), end[token].tolist())}
    single, parted = letter | sign, kind & _SEPARATOR != 0
    after = np.append(True, kind[:-1] & (_LETTER | _DIGIT) == 0)
    if len(points) >= 5:
        for start in np.flatnonzero(after[:-4] & single[:-4] & parted[1:-3] & single[2:-2] & parted[3:-1] & single[4:]).tolist():
            if m := _run_pattern().match(text, start):
                found[start] = (m.end(), True)
    return [(start, *found[start]) for start in sorted(found)]


def _parts(token: str, run: bool) -> Iterator[str]:
    """A run that holds a letter; a token in parts of ``LONGEST`` signs, each beginning in the middle of the one before."""
    if not run:
        yield from (token[cut : cut + LONGEST] for cut in range(0, max(len(token) - LONGEST // 2, 1), LONGEST // 2))
    elif any(c.isalpha() for c in token):
        yield token


def _ways(part: str, run: bool) -> Iterator[tuple[str, bool]]:
    """What of a part is to be decoded, and whether signs at its ends must be letters."""
    if run:
        yield part, True
        return
    yield part, False
    for kept in dict.fromkeys((part, part.strip(_PUNCTUATION))):
        if _AT_AN_END.search(kept):
            yield kept, True


def readings(text: str, model: np.ndarray) -> Iterator[tuple[int, str, bool, bool]]:
    """Where tokens that look disguised begin, what is to be decoded, whether signs at its ends must be letters, and whether it is a run."""
    for start, end, run in spots(text, _rare_twice(model)):
        for part in _parts(text[start:end].lower(), run):
            for kept, ends in _ways(part, run):
                yield start, kept, ends, run


def _words_of(made: str, run: bool) -> str:
    """Words to make features of. Where a run's word ends is not known: every beginning of three letters or more may be it."""
    if not run or not made:
        return made
    word = made.split()[0]
    return " ".join([word[:size] for size in range(3, len(word))] + [word])


def _features(data: np.ndarray, begin: np.ndarray, until: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """One row per word: hashes of its beginnings and of itself; 0 where it is too short."""
    out = np.zeros((len(begin), len(PREFIXES) + 1), np.uint64)
    out[:, -1] = mix(whole + np.uint64(99))
    for j, size in enumerate(PREFIXES):
        enough = np.flatnonzero(until - begin >= size)
        low = data[begin[enough][:, None] + np.arange(size)].astype(np.uint64)
        low |= np.where((low >= 65) & (low <= 90), np.uint64(32), np.uint64(0))
        h = np.full(len(enough), size, np.uint64)
        for k in range(size):
            h = h * np.uint64(1_000_003) + low[:, k]
        out[enough, j] = mix(h)
    return out


class _Restored:
    """Features of the words behind a part, its ways of reading together: rows, left neighbours, and where a way begins. Each part is decoded once, as long as it is remembered."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model
        self.young: dict[tuple[str, bool], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.old: dict = {}

    def look_up(self, wanted: list[tuple[str, bool]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        different = dict.fromkeys(wanted)
        own = {w: self.young.get(w) or self.old.get(w) for w in different}
        new = [w for w in different if own[w] is None]
        own.update(zip(new, self._make(new)))
        self.young.update(own)
        if len(self.young) > REMEMBERED:
            self.old, self.young = dict(list(self.young.items())[-REMEMBERED:]), {}
        return [own[w] for w in wanted]

    def _make(self, parts: list[tuple[str, bool]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, len(parts), 4096):
            some = parts[at : at + 4096]
            ways = [list(_ways(*p)) for p in some]
            made: dict[tuple[str, bool], str] = {}
            for ends in (False, True):
                tokens = list({t: None for w in ways for t, e in w if e == ends})
                made.update(zip(((t, ends) for t in tokens), restore(tokens, self.model, ends)))
            flat = [_words_of(made[w].strip(), run).encode() for own, (_, run) in zip(ways, some) for w in own]
            offsets = np.append(0, np.cumsum([len(f) for f in flat]))
            data = np.frombuffer(b"".join(flat), np.uint8)
            hashes, begin, until, first = words(data, offsets, _NOT_LETTERS, lower=True)
            rows = _features(data, begin, until, hashes)
            left = np.append(np.zeros(1, np.uint64), hashes)[:-1]
            leads = np.zeros(len(hashes) + 1, bool)
            leads[first[:-1]] = True
            way = 0
            for own in ways:
                low, high = first[way], first[way + len(own)]
                yield rows[low:high].copy(), left[low:high].copy(), leads[low:high].copy()
                way += len(own)


def _text_features(texts: pa.Array, restored: _Restored) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: features of its words, plain and restored (rows), and the hash of each word's left neighbour."""
    data, offsets = utf8(texts)
    rare = _rare_twice(restored.model)
    for first, last in blocks(offsets, 1 << 20):
        low = offsets[first]
        part = data[low : offsets[last]]
        hashes, begin, until, at = words(part, offsets[first : last + 1] - low, _NOT_LETTERS, lower=True)
        found = _features(part, begin, until, hashes)
        left = np.append(np.zeros(1, np.uint64), hashes)[:-1]
        left[at[:-1][at[:-1] < len(left)]] = 0  # a text's first word has none
        raw = part.tobytes()
        edges = (offsets[first : last + 1] - low).tolist()
        parted = [raw[a:b].decode() for a, b in zip(edges, edges[1:])]
        opens = np.cumsum([0, *(len(t) + 1 for t in parted)])  # texts are joined by line ends, which no match crosses
        together = "\n".join(parted)
        wanted, places = [], []
        for start, end, run in spots(together, rare):
            for p in _parts(together[start:end].lower(), run):
                wanted.append((p, run))
                places.append(start)
        if wanted:
            entries = restored.look_up(wanted)
            place = np.array(places, np.int64)
            owner = np.searchsorted(opens, place, "right") - 1
            byte = np.flatnonzero((part & 0xC0) != 0x80)[place - owner]
            before = np.searchsorted(begin, byte) - 1  # the last word that begins before the token
            word = np.where(before >= at[owner], hashes[before] if len(hashes) else np.uint64(0), np.uint64(0))
            size = np.array([len(e[1]) for e in entries])
            more, beside, leads = (np.concatenate([e[j] for e in entries]) for j in range(3))
            beside[leads] = np.repeat(word, size)[leads]
            span = np.searchsorted(np.repeat(owner, size), np.arange(last - first + 1))
        for k in range(last - first):
            rows, context = found[at[k] : at[k + 1]], left[at[k] : at[k + 1]]
            if wanted and span[k] < span[k + 1]:
                rows = np.concatenate([rows, more[span[k] : span[k + 1]]])
                context = np.concatenate([context, beside[span[k] : span[k + 1]]])
            yield rows, context


def _batches(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """id, text, toxic -> the features of few texts at a time, with left neighbour, text id and label of each."""
    restored = _Restored(model)
    for whole in batches:
        for at in range(0, whole.num_rows, 128):
            batch = whole.slice(at, 128)
            keys, lefts, own, marks = [], [], [], []
            for i, (rows, context), toxic in zip(batch.column(0).to_pylist(), _text_features(batch.column(1), restored), batch.column(2).to_pylist()):
                keys.append(rows.ravel())
                lefts.append(np.repeat(context, rows.shape[1]))
                own.append(np.full(rows.size, i, np.int64))
                marks.append(np.full(rows.size, toxic == 1))
            if keys:
                yield tuple(map(np.concatenate, (keys, lefts, own, marks)))


def _bounds(model: np.ndarray):
    """id, text, toxic -> for each feature by label: in how many rows it is, and 64 hashed classes of its left neighbours and texts, as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, left, own, mark in _batches(batches, model):
            # An id that is repeated in another batch counts again, so ``n`` is never below the number of texts.
            if not len(key):
                continue
            order = np.lexsort((own, mark, key))
            key, left, own, mark = (x[order] for x in (key, left, own, mark))
            change = np.append(True, (key[1:] != key[:-1]) | (mark[1:] != mark[:-1]))
            begin = np.flatnonzero(change)
            n = np.add.reduceat((change | np.append(True, own[1:] != own[:-1])).astype(np.int64), begin)
            bits = [pa.array(np.bitwise_or.reduceat(np.uint64(1) << (mix(x.view(np.uint64)) & np.uint64(63)), begin).view(np.int64)) for x in (left, own)]
            yield pa.RecordBatch.from_arrays([pa.array(key[begin].view(np.int64)), pa.array(mark[begin]), pa.array(n), *bits], names=["feature", "toxic", "n", "left", "texts"])

    return run


def _seen(model: np.ndarray, wanted: np.ndarray):
    """id, text, toxic -> the left neighbours (kinds 0 clean, 1 toxic) and texts (kinds 2, 3) of the features ``wanted``, in order.

    A feature is named by four times its place among these, plus the kind: small numbers, as many rows are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, left, own, mark in _batches(batches, model):
            key = key.view(np.int64)
            if not len(wanted):
                continue
            place = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
            hit = wanted[place] == key
            place, left, own, mark = place[hit], left[hit].view(np.int64), own[hit], mark[hit].astype(np.int64)
            for kind, value in ((mark, left), (mark + 2, own)):
                code = 4 * place + kind
                order = np.lexsort((value, code))
                c, v = code[order], value[order]
                new = np.append(True, (c[1:] != c[:-1]) | (v[1:] != v[:-1])) if len(c) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(c[new]), pa.array(v[new])], names=["code", "value"])

    return run


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Features worth more than 1/2 and their scores, from labelled texts (``labels``: id and label of the training rows)."""
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).cast("bigint").alias("id")).agg(F.max(label_column).alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    share = F.create_map(*[F.lit(x) for t in (0, 1) for x in (t, min(1.0, SAMPLE / max(sizes.get(t, 0), 1)))])
    place = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(place < share[F.col("toxic")])
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    # The sample's size is bounded by SAMPLE, so it may be sent to every task.
    chosen = texts.join(F.broadcast(sample), "id").select("id", "text", "toxic")
    # A score over 1/2 needs a >= 3 and b < a. Rows bound a from above and classes b from below, so no such feature is left out here.
    rows = chosen.mapInArrow(_bounds(model), "feature bigint, toxic boolean, n bigint, left bigint, texts bigint").where("feature <> 0")
    classes = lambda c: F.bit_count(F.coalesce(F.bit_or(F.when(~F.col("toxic"), F.col(c))), F.lit(0)))
    bounds = rows.groupBy("feature").agg(F.sum(F.when(F.col("toxic"), F.col("n"))).alias("most"), F.least(classes("left"), classes("texts")).alias("least"))
    wanted = np.sort(bounds.where("most >= 3 and least < most").select("feature").toArrow()["feature"].to_numpy())
    seen = chosen.mapInArrow(_seen(model, wanted), "code bigint, value bigint").distinct()
    number = lambda kind: F.count_if(F.col("code") % 4 == kind)
    counted = seen.groupBy(F.shiftright("code", 2).alias("place")).agg(F.least(number(1), number(3)).alias("a"), F.least(number(0), number(2)).alias("b"))
    a, b = F.col("a"), F.col("b")
    score = (a + 0.5) / (a + b + 1) * a / (a + 1.5)
    strong = counted.select("place", score.alias("score")).where("score > 0.5").toArrow()
    key, value = wanted[strong["place"].to_numpy()], strong["score"].to_numpy()
    order = np.argsort(key)
    return key[order], value[order]


def _score(model: np.ndarray, key: np.ndarray, value: np.ndarray):
    """Texts to scores, as a column function: the other columns of a row never reach a Python worker."""
    bits = np.zeros(1 << 20, bool)
    bits[key & (len(bits) - 1)] = True

    def scored(texts: pa.Array, restored: _Restored) -> Iterator[float]:
        for rows, _ in _text_features(texts, restored):
            flat = rows.ravel().view(np.int64)
            maybe = flat[bits[flat & (len(bits) - 1)]] if len(key) else flat[:0]
            at = np.minimum(np.searchsorted(key, maybe), max(len(key) - 1, 0))
            hit = value[at[key[at] == maybe]] if len(maybe) else value[:0]
            yield float(hit.max()) if len(hit) else 0.1 * len(rows) / (len(rows) + 1000)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restored = _Restored(model)
        for texts in batches:
            yield pa.array(scored(texts, restored), pa.float64())

    return F.arrow_udf(score, "double", ArrowUDFType.SCALAR_ITER)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", keep: Sequence[str] = ()
) -> DataFrame:
    """Per row of ``docs``: id, score and, if ``keep`` is given, the text and these columns as a struct ``row``. ``labels`` holds the rows to learn from."""
    model = character_model(docs, text_column)
    key, value = train(docs, labels, model, id_column, text_column, label_column)
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"), *carried(keep))
    return texts.withColumn("score", _score(model, key, value)("text")).select("id", "score", *(["text", "row"] if keep else []))


def held_out(id_column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves remainder 1 by 3; a missing id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))
