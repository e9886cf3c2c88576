"""A vocabulary of text pieces in a double-array trie, and lattices of all pieces that match a text.

Text is brought to the form the pieces are written in (spaces as the marker
U+2581, one marker before the text), cut into runs that no piece reaches across, and
equal runs of a block are handled once. All byte positions walk the trie
together, one byte per step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np

from riskweave.llm.textkit import span_hashes

MARKER = "▁"
_MARKER = MARKER.encode()


@dataclass(frozen=True)
class Pieces:
    """``base``/``check``/``piece_at`` are the double array; ``scores`` log probabilities; ``byte_ids`` the fallback for unknown characters.

    The arrays' size is that of the vocabulary, whatever the corpus.
    """

    base: np.ndarray
    check: np.ndarray
    piece_at: np.ndarray
    texts: tuple[bytes, ...]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown_id: int
    cuts_at_markers: bool

    @property
    def unknown_score(self) -> np.float32:
        """What an unknown character costs: 10 less than the least likely piece."""
        return np.float32(self.scores[self.scores > -np.inf].min() - np.float32(10))


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): state t = base[s] + byte follows s if check[t] = s; state 0 is the root."""
    trie: list[dict[int, int]] = [{}]
    values = [-1]
    for word, value in words.items():
        node = 0
        for byte in word:
            if byte not in trie[node]:
                trie[node][byte] = len(trie)
                trie.append({})
                values.append(-1)
            node = trie[node][byte]
        values[node] = value
    used = bytearray(4 * len(trie) + 1024)
    base, check, value = (np.zeros(len(used), np.int32), np.full(len(used), -1, np.int32), np.full(len(used), -1, np.int32))
    used[0] = 1
    place = {0: 0}
    free = 1
    todo = [0]
    while todo:
        node = todo.pop()
        at = place[node]
        value[at] = values[node]
        children = sorted(trie[node])
        if not children:
            continue
        slot = max(free, children[0] + 1)
        while True:
            slot = used.find(0, slot)
            begin = slot - children[0]
            if all(not used[begin + c] for c in children):
                break
            slot += 1
        base[at] = begin
        for c in children:
            used[begin + c] = 1
            check[begin + c] = at
            place[trie[node][c]] = begin + c
            todo.append(trie[node][c])
        free = used.find(0, free)
    size = max(place.values()) + 257
    return base[:size], check[:size], value[:size]


def load_pieces(path: str) -> Pieces:
    """Reads a piece model file.

    Scores of a unigram model are log probabilities as they stand. A model of
    merges has ranks for scores (-rank); its pieces get log probabilities by
    Zipf's law, p ~ 1 / (rank + 2), normalised over the vocabulary.
    """
    from sentencepiece import sentencepiece_model_pb2 as model

    proto = model.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    kind = model.ModelProto.SentencePiece
    normal = {p.piece.encode(): i for i, p in enumerate(proto.pieces) if p.type in (kind.NORMAL, kind.USER_DEFINED)}
    scores = np.full(len(proto.pieces), -np.inf)
    ids = np.fromiter(normal.values(), np.int64)
    raw = np.array([proto.pieces[i].score for i in ids], dtype=np.float64)
    if proto.trainer_spec.model_type == model.TrainerSpec.BPE:
        raw = -np.log(2.0 - raw)
        raw -= np.log(np.exp(raw).sum())
    scores[ids] = raw
    byte_ids = np.full(256, -1, dtype=np.int32)
    texts = [b""] * len(proto.pieces)
    for i, p in enumerate(proto.pieces):
        if p.type == kind.BYTE:
            byte = int(re.fullmatch(r"<0x([0-9A-F]{2})>", p.piece)[1], 16)
            byte_ids[byte] = i
            texts[i] = bytes([byte])
        elif p.type in (kind.NORMAL, kind.USER_DEFINED):
            texts[i] = p.piece.replace(MARKER, " ").encode()
    unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
    cuts = not any(re.search(f"[^{MARKER}]{MARKER}", w.decode()) for w in normal)
    return Pieces(*double_array(normal), tuple(texts), scores.astype(np.float32), byte_ids, unknown, cuts)


class Runs(NamedTuple):
    """Distinct runs of a block: ``data`` of all, run r in ``start[r]:start[r + 1]`` with the ascending hash ``key[r]``; ``order`` names the run at each place of the block, ``doc`` its document."""

    data: np.ndarray
    start: np.ndarray
    order: np.ndarray
    doc: np.ndarray
    key: np.ndarray


def bytes_at(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the spans one after the other, where each begins and the last ends)."""
    at = np.concatenate(([0], np.cumsum(length)))
    return data[np.repeat(start - at[:-1], length) + np.arange(at[-1])], at


def runs_of(texts: list[str], pieces: Pieces) -> Runs:
    """Distinct runs of texts in marker form."""
    parts = [(MARKER + t.replace(" ", MARKER)).encode() if t else b"" for t in texts]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int64)
    if not len(data):
        return Runs(data, np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    begins = np.zeros(len(data), dtype=bool)
    begins[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    if pieces.cuts_at_markers:
        padded = np.concatenate((np.zeros(3, np.uint8), data, np.zeros(2, np.uint8)))
        marker = (padded[:-2] == _MARKER[0]) & (padded[1:-1] == _MARKER[1]) & (padded[2:] == _MARKER[2])
        begins |= marker[3:] & ~marker[:-3]
    start = np.flatnonzero(begins)
    end = np.concatenate((start[1:], [len(data)]))
    key, first, order = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
    own, at = bytes_at(data, start[first], (end - start)[first])
    return Runs(own, at, order, np.searchsorted(offsets, start, "right") - 1, key)


def slices(runs: Runs, picked: np.ndarray, size: int) -> Iterator[tuple[int, int, Runs]]:
    """(first, last + 1, runs) of the picked runs in portions of about ``size`` bytes, one run at least."""
    length = np.diff(runs.start)[picked]
    upto = np.concatenate(([0], np.cumsum(length)))
    first, none = 0, np.zeros(0, np.int64)
    while first < len(picked):
        last = min(len(picked), max(first + 1, int(np.searchsorted(upto, upto[first] + size, "right")) - 1))
        data, start = bytes_at(runs.data, runs.start[picked[first:last]], length[first:last])
        yield first, last, Runs(data, start, none, none, runs.key[picked[first:last]])
        first = last


class Lattice(NamedTuple):
    """Every piece that matches in a run. Nodes are byte borders: byte p of run r begins at node p + r.

    Edges are sorted by how far into its run they begin; ``steps[i]:steps[i + 1]``
    are those that begin i bytes in. ``piece`` is -1 for an unknown character.
    """

    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    run: np.ndarray
    steps: np.ndarray


def lattice_of(runs: Runs, pieces: Pieces) -> Lattice:
    data, n = runs.data, len(runs.start) - 1
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    next_head = np.concatenate((heads[1:], [len(data)]))
    run_of = np.repeat(np.arange(n), np.diff(runs.start))
    limit = runs.start[1:][run_of] if n else np.zeros(0, np.int64)
    place = np.arange(len(heads))
    at, state = heads.copy(), np.zeros(len(heads), dtype=np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    single = np.zeros(len(heads), dtype=bool)
    while len(place):
        onward = pieces.base[state] + data[at]
        good = pieces.check[onward] == state
        place, at, state = place[good], at[good] + 1, onward[good]
        piece = pieces.piece_at[state]
        hit = piece >= 0
        found.append((place[hit], at[hit], piece[hit]))
        single[place[hit][at[hit] == next_head[place[hit]]]] = True
        more = at < limit[heads[place]]
        place, at, state = place[more], at[more], state[more]
    unknown = np.flatnonzero(~single)
    found.append((unknown, next_head[unknown], np.full(len(unknown), -1, dtype=np.int32)))
    place = np.concatenate([f[0] for f in found])
    target, piece = np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])
    begin = heads[place]
    run = run_of[begin]
    into = begin - runs.start[run]
    order = np.argsort(into.astype(np.uint16) if not len(into) or into.max() < 1 << 16 else into, kind="stable")
    steps = np.concatenate(([0], np.cumsum(np.bincount(into))))
    begin, target, piece, run = begin[order], target[order], piece[order], run[order]
    return Lattice(begin + run, target + run, piece, run, steps)
