"""Token counts from a byte-level BPE vocabulary compiled to finite-state transducers.

Two deterministic transducers take the place of the tokenizer's merge loop:

* The *splitter* reads character classes and marks where pre-tokens begin. Its
  dozen states know whether a run of white space or a contraction is open. A
  block of text is cut into chunks of equal length; each chunk's state map
  (state before -> state after, for every state) is found for all chunks at
  once, the maps are composed by a parallel prefix scan, and with the state
  before each chunk known, all chunks emit their marks at once.
* The *counter* reads the bytes of a pre-token. Its states hold the open
  starts (trie node, token before it, tokens so far above the fewest); its
  transitions are annotated with the tokens that became certain, its states
  with those still open. It rests on a property of merge tables: the encoding
  of a prefix is a prefix of a token chain in which every two neighbours could
  not have merged across their border, so exactly one last token fits at every
  byte. Transitions are compiled when first met and kept in a hash table per
  Python worker; ``MAX_STATES`` bounds it (beyond, it starts afresh between two
  blocks; results don't change).

Only pre-token borders need the splitter's scan: the counter begins anew at
each of them, which makes its state map over a border constant.

Defined cases: null text counts as empty; the empty text has no tokens; special
strings inside a text are one token each, as the library does by default; any
length of text is read whole. Repeated rows each get their count; an empty
table gives an empty result. Only the id and the text column are read, so other
columns may have any name.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.textkit import PerWorker, Texts, blocks

CHUNK = 256
MAX_STATES = 1 << 18
#: The split pattern that the splitter implements (fixed value of byte-level vocabularies).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Character classes. FIRST is added for the first character of a segment.
LETTER, SHORT, RV, EL, EE, NUMBER, SPACE, BLANK, QUOTE, OTHER, SPECIAL = range(11)
FIRST = 11
PAD = 2 * FIRST
N_CLASSES = PAD + 1

# States of the splitter: what the current pre-token is. One/Many: length of a run of white space.
(BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_SPACE, MANY_SPACE, ONE_BLANK, MANY_BLANK, AFTER_QUOTE, WANTS_E, WANTS_L, CLOSED) = range(12)
N_STATES = 12
HERE, BEFORE = 1, 2  # a pre-token begins at this character, at the one before

_LETTERS = {LETTER, SHORT, RV, EL, EE}


def _move(state: int, kind: int) -> tuple[int, int]:
    """Next state and marks of the splitter, for a character inside a segment."""
    if kind == SPECIAL:
        return BEGIN, BEFORE * (state in (WANTS_E, WANTS_L))
    if state in (WANTS_E, WANTS_L):
        if (state, kind) in ((WANTS_E, EE), (WANTS_L, EL)):
            return CLOSED, 0
        after, marks = _move(IN_LETTERS, kind)  # no contraction: the letter before began a word
        return after, marks | BEFORE
    if state == AFTER_QUOTE:
        if kind == SHORT:
            return CLOSED, 0
        if kind == RV:
            return WANTS_E, 0
        if kind == EL:
            return WANTS_L, 0
        state = IN_OTHER
    if kind in (SPACE, BLANK):
        if state in (ONE_SPACE, ONE_BLANK, MANY_SPACE, MANY_BLANK):
            return (MANY_SPACE if kind == SPACE else MANY_BLANK), 0
        return (ONE_SPACE if kind == SPACE else ONE_BLANK), HERE
    target = IN_LETTERS if kind in _LETTERS else IN_NUMBERS if kind == NUMBER else IN_OTHER
    if state == target:
        return target, 0
    if state == ONE_SPACE:  # joins what follows
        return target, 0
    if state == MANY_SPACE:
        return target, BEFORE
    marks = HERE | (BEFORE if state == MANY_BLANK else 0)
    return (AFTER_QUOTE if kind == QUOTE else target), marks


def splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by class and state."""
    after = np.zeros((N_CLASSES, N_STATES), dtype=np.uint8)
    marks = np.zeros((N_CLASSES, N_STATES), dtype=np.uint8)
    for state in range(N_STATES):
        for kind in range(FIRST):
            after[kind, state], marks[kind, state] = _move(state, kind)
            begun, own = _move(BEGIN, kind)
            after[FIRST + kind, state] = begun
            marks[FIRST + kind, state] = own | (BEFORE if state in (WANTS_E, WANTS_L) else 0)
        after[PAD, state] = state
    return after, marks


def character_classes() -> np.ndarray:
    """Class of every code point, by the tokenizers library's own Unicode tables."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))).astype(np.uint32)
    every = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        inside = np.ones(len(points), dtype=bool)
        for _, (low, high) in Split(Regex(pattern), "removed").pre_tokenize_str(every):
            inside[low:high] = False
        out[points[inside]] = kind
    for chars, kind in (("stmd", SHORT), ("rv", RV), ("l", EL), ("e", EE), (" ", SPACE), ("'", QUOTE)):
        out[[ord(c) for c in chars]] = kind
    return out


@dataclass(frozen=True)
class Vocabulary:
    """A compiled vocabulary file; its size is that of the vocabulary, whatever the corpus."""

    classes: np.ndarray
    child: dict[int, int]
    token_at: list[int]
    inner: list[bool]
    ranks: dict[tuple[int, int], int]
    right: list[tuple]
    left: list[tuple]
    specials: tuple[bytes, ...] = ()


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    hidden = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(hidden)}


def compile_vocabulary(path: str) -> Vocabulary:
    """Reads a byte-level BPE file of the tokenizers library.

    Raises ValueError for files with a normaliser, another splitting or special
    strings that take white space along, because the splitter has no states for these.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or spec.get("normalizer"):
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
    added = spec.get("added_tokens", [])
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError(f"{path}: special strings with their own white-space rules")
    byte = _byte_of_char()
    special = {a["content"] for a in added}
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    size = max(model["vocab"].values()) + 1
    ranks, parts = {}, {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        ranks[ids[a], ids[b]] = rank
        parts[ids[a + b]] = (ids[a], ids[b], rank)

    def border(token: int, side: int) -> tuple:
        """The tokens that stand at one border of ``token`` while it is merged, with the rank that uses each up."""
        out, used = [], 1 << 60
        while True:
            out.append((token, used))
            if token not in parts:
                return tuple(out)
            *halves, used = parts[token]
            token = halves[side]

    right, left = [()] * size, [()] * size
    child: dict[int, int] = {}
    token_at, inner = [-1], [True]
    for text, i in ids.items():
        right[i], left[i] = border(i, 1), border(i, 0)
        node = 0
        for char in text:
            key = node << 8 | byte[char]
            inner[node] = True
            node = child.setdefault(key, len(token_at))
            if node == len(token_at):
                token_at.append(-1)
                inner.append(False)
        token_at[node] = i
    return Vocabulary(character_classes(), child, token_at, inner, ranks, right, left, tuple(s.encode() for s in sorted(special, key=len, reverse=True)))


@dataclass
class Counter:
    """The counting transducer, compiled transition by transition.

    State 0 is the beginning of a pre-token. ``keys``/``nexts``/``emits`` are an
    open hash table of transitions, keyed by ``state << 8 | byte``.
    """

    vocabulary: Vocabulary
    bits: int = 16
    states: dict[tuple, int] = field(default_factory=dict)
    open_starts: list[tuple] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._fits: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        begin = (0, -1, 0)
        self.states, self.open_starts = {begin: 0}, [begin]
        self.pending = np.zeros(1024, dtype=np.int32)
        self._fits.clear()
        self._allot(16)

    def _allot(self, bits: int) -> None:
        self.bits, self.filled = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.nexts = np.zeros(1 << bits, dtype=np.int32)
        self.emits = np.zeros(1 << bits, dtype=np.int16)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` can follow ``a``: no merge joins their borders before both are complete."""
        known = self._fits.get((a, b))
        if known is None:
            ranks = self.vocabulary.ranks
            known = True
            for x, used_x in self.vocabulary.right[a]:
                for y, used_y in self.vocabulary.left[b]:
                    rank = ranks.get((x, y))
                    if rank is not None and rank < used_x and rank <= used_y:
                        known = False
            self._fits[a, b] = known
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """Target and emitted tokens of one transition."""
        v, starts, out, last, count = self.vocabulary, self.open_starts[state], [], None, 0
        for k in range(0, len(starts), 3):
            node = v.child.get(starts[k] << 8 | byte)
            if node is None:
                continue
            token = v.token_at[node]
            if last is None and token >= 0 and (starts[k + 1] < 0 or self.fits(starts[k + 1], token)):
                last, count = token, starts[k + 2] + 1
            if v.inner[node]:
                out += (node, starts[k + 1], starts[k + 2])
        if last is None:
            raise ValueError("the vocabulary lacks a byte")
        out += (0, last, count)
        settled = min(out[2::3])
        key = tuple(x - settled if k % 3 == 2 else x for k, x in enumerate(out))
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = len(self.open_starts)
            self.open_starts.append(key)
            if target == len(self.pending):
                self.pending = np.concatenate((self.pending, np.zeros_like(self.pending)))
            self.pending[target] = count - settled
        return target, settled

    def _put(self, keys: np.ndarray, nexts: np.ndarray, emits: np.ndarray) -> None:
        if 2 * (self.filled + len(keys)) > len(self.keys):
            kept = self.keys >= 0
            keys, nexts, emits = (np.concatenate((old[kept], new)) for old, new in ((self.keys, keys), (self.nexts, nexts), (self.emits, emits)))
            self._allot(max(self.bits + 1, int(4 * len(keys)).bit_length()))
        self.filled += len(keys)
        slot = self._slots(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of several for one slot, the last stays
            done = self.keys[slot] == keys
            self.nexts[slot[done]], self.emits[slot[done]] = nexts[done], emits[done]
            keys, nexts, emits, slot = keys[~done], nexts[~done], emits[~done], slot[~done]
            slot = (slot + 1) & (len(self.keys) - 1)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each key, and which of them are not compiled yet."""
        slot = self._slots(keys)
        held = self.keys[slot]
        todo = np.flatnonzero(held != keys)
        absent = np.zeros(len(keys), dtype=bool)
        while len(todo):
            empty = held[todo] == -1
            absent[todo[empty]] = True
            todo = todo[~empty]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            held[todo] = self.keys[slot[todo]]
            todo = todo[held[todo] != keys[todo]]
        return slot, absent

    def run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each span of bytes, all spans stepping together."""
        if len(self.open_starts) > MAX_STATES:
            self.clear()
        order = np.argsort(start - end, kind="stable")
        begin, length = start[order], (end - start)[order]
        state = np.zeros(len(order), dtype=np.int64)
        tokens = np.zeros(len(order), dtype=np.int64)
        active = len(order)
        for step in range(int(length[0]) if active else 0):
            active = int(np.searchsorted(-length[:active], -step, "left"))
            keys = state[:active] << 8 | data[begin[:active] + step]
            slot, absent = self._find(keys)
            if absent.any():
                new = np.unique(keys[absent])
                made = np.array([self._compile(int(k) >> 8, int(k) & 255) for k in new], dtype=np.int64)
                self._put(new, made[:, 0].astype(np.int32), made[:, 1].astype(np.int16))
                slot, _ = self._find(keys)
            state[:active] = self.nexts[slot]
            tokens[:active] += self.emits[slot]
        out = np.empty_like(tokens)
        out[order] = tokens + self.pending[state]
        return out


_AFTER, _MARKS = splitter_tables()


def scan_states(kinds: np.ndarray) -> np.ndarray:
    """State before each chunk. ``kinds``: classes by place in the chunk and chunk.

    Every chunk's state map is built for all states at once; the maps are then
    composed by doubling, so after log2(chunks) rounds each holds the map from
    the beginning of the block.
    """
    n = kinds.shape[1]
    maps = np.repeat(np.arange(N_STATES, dtype=np.uint8)[None, :], n, axis=0)
    for row in kinds:
        maps = _AFTER[row[:, None], maps]
    span = 1
    while span < n:
        maps[span:] = np.take_along_axis(maps[span:], maps[:-span], axis=1)
        span *= 2
    before = np.full(n, BEGIN, dtype=np.uint8)
    before[1:] = maps[:-1, BEGIN]
    return before


def split_marks(kinds: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where pre-tokens begin, for the classes of a block of characters."""
    n = len(kinds)
    chunks = (n + chunk) // chunk  # one place more than characters: the end flushes what is open
    padded = np.full(chunks * chunk, PAD, dtype=np.uint8)
    padded[:n] = kinds
    padded[n] = SPECIAL
    by_place = np.ascontiguousarray(padded.reshape(chunks, chunk).T)
    state = scan_states(by_place)
    marks = np.empty_like(by_place)
    for i, row in enumerate(by_place):
        marks[i] = _MARKS[row, state]
        state = _AFTER[row, state]
    flat = marks.T.reshape(-1)
    begins = (flat[:n] & HERE) > 0
    begins |= (flat[1 : n + 1] & BEFORE) > 0
    return begins


def special_spans(texts: Texts, specials: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """Byte spans of special strings, leftmost first, the longest of those that begin at one place."""
    if not specials:
        return []
    raw, found, at = texts.data.tobytes(), [], 0
    nexts = {s: raw.find(s) for s in specials}
    while any(p >= 0 for p in nexts.values()):
        place, string = min(((p, s) for s, p in nexts.items() if p >= 0), key=lambda x: (x[0], -len(x[1])))
        doc = np.searchsorted(texts.offsets, place, "right")
        if place + len(string) <= texts.offsets[doc]:
            found.append((place, place + len(string)))
            at = place + len(string)
        else:
            at = place + 1
        nexts = {s: raw.find(s, at) if 0 <= p < at else p for s, p in nexts.items()}
    return found


def count_block(texts: Texts, counter: Counter) -> np.ndarray:
    """Tokens of each document of a block."""
    n = len(texts)
    data = texts.data
    if not len(data):
        return np.zeros(n, dtype=np.int64)
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    kinds = counter.vocabulary.classes[points]
    filled = texts.offsets[:-1][texts.offsets[1:] > texts.offsets[:-1]]
    first = np.zeros(len(kinds), dtype=bool)
    first[np.searchsorted(heads, filled)] = True
    spans = special_spans(texts, counter.vocabulary.specials)
    for low, high in spans:
        low, high = np.searchsorted(heads, (low, high))
        kinds[low:high] = SPECIAL
        if high < len(first):
            first[high] = True
    kinds[first] += FIRST
    begins = heads[split_marks(kinds)]
    stops = np.concatenate((begins, [len(data)]))
    end = stops[1:].copy()
    if spans:  # pre-tokens end where a special string begins
        lows = np.array([s[0] for s in spans])
        after = np.searchsorted(lows, begins)
        inside = after < len(lows)
        end[inside] = np.minimum(end[inside], lows[after[inside]])
    tokens = counter.run(data, begins, end)
    doc = np.searchsorted(texts.offsets, begins, "right") - 1
    out = np.bincount(doc, weights=tokens, minlength=n).astype(np.int64)
    if spans:
        out += np.bincount(np.searchsorted(texts.offsets, lows, "right") - 1, minlength=n)
    return out


RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def token_counter(spark: SparkSession, path: str):
    """A column function text -> (n_bytes, n_tokens) for the vocabulary file at ``path``.

    The driver compiles the vocabulary once and broadcasts it; its size depends on the file alone.
    """
    counter = PerWorker(spark, compile_vocabulary(path), Counter)

    @F.arrow_udf(RESULT)
    def counts(text: pa.Array) -> pa.Array:
        sizes = [np.zeros(0, np.int64)]
        tokens = [np.zeros(0, np.int64)]
        for _, _, texts in blocks(text, 1 << 20):
            sizes.append(np.diff(texts.offsets))
            tokens.append(count_block(texts, counter.get()))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(sizes)), pa.array(np.concatenate(tokens))], names=["n_bytes", "n_tokens"])

    return counts


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``)."""
    counts = token_counter(docs.sparkSession, path)
    return (
        docs.select(F.col(id_col), counts(F.col(text_col)).alias("counts"))
        .select(id_col, "counts.n_bytes", "counts.n_tokens")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
