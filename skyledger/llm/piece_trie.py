"""A fixed public vocabulary of pieces in a double-array trie over UTF-8 bytes, walked for many words at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Folder of the public tokenizers' vocabulary files; a parameter of every user.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"


@dataclass
class PieceTrie:
    """``base`` and ``check`` of the double array (a node's child by byte b is base[node] + b), ``piece`` of each node or -1."""

    pieces: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    longest: int


def load_vocabulary(path: str) -> tuple[list[str], np.ndarray, np.ndarray, int, set[int]]:
    """Pieces, scores, ids of the 256 byte pieces (-1 where absent), the unknown id, and ids that text never yields."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    scores = np.array([model.get_score(i) for i in range(n)])
    byte_ids = np.full(256, -1, np.int32)
    hidden = set()
    for i in range(n):
        if model.is_byte(i):
            byte_ids[int(pieces[i][3:5], 16)] = i
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            hidden.add(i)
    return pieces, scores, byte_ids, model.unk_id(), hidden


def build_trie(path: str = VOCABULARY) -> PieceTrie:
    pieces, scores, byte_ids, unknown, hidden = load_vocabulary(path)
    tree: list[dict[int, int]] = [{}]
    value = [-1]
    for i, text in enumerate(pieces):
        if i in hidden or not text:
            continue
        node = 0
        for b in text.encode():
            if b not in tree[node]:
                tree[node][b] = len(tree)
                tree.append({})
                value.append(-1)
            node = tree[node][b]
        value[node] = i
    size = 4 * len(tree) + 512
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    taken = bytearray(size)
    taken[0] = 1
    low, wide, queue = 1, 1, [(0, 0)]
    for node, slot in queue:
        piece[slot] = value[node]
        if not tree[node]:
            continue
        children = sorted(tree[node])
        low = taken.index(0, low)
        start = max(1, (low if len(children) == 1 else max(low, wide)) - children[0])
        at = start
        while any(taken[at + b] for b in children):
            at = max(at + 1, taken.index(0, at + children[0]) - children[0])
        if len(children) > 1 and at - start > 64:
            wide = at  # crowded below: later nodes with several children look from here
        base[slot] = at
        for b in children:
            taken[at + b] = 1
            check[at + b] = slot
            queue.append((tree[node][b], at + b))
    used = taken.rindex(1) + 257
    return PieceTrie(pieces, scores, byte_ids, unknown, base[:used], check[:used], piece[:used], max(len(pieces[i].encode()) for i in range(len(pieces)) if i not in hidden))


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words as a matrix, zero beyond each end, and their lengths."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max(initial=0))
    return np.frombuffer(b"".join(w.ljust(width + 1, b"\0") for w in words), np.uint8).reshape(len(words), width + 1), lengths


def marked(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words with a marker before each as a matrix, zero beyond each end, and their lengths."""
    text, mark = "\0".join(words), SPACE.encode()
    if text.count("\0") != len(words) - 1:  # a word holds the separator itself
        return padded([mark + w.encode() for w in words])
    b = np.frombuffer(f"\0{text}\0".encode(), np.uint8)
    ends = np.flatnonzero(b == 0)
    starts, sizes = ends[:-1] + 1, np.diff(ends) - 1
    at = np.arange(int(sizes.max()))
    m = np.zeros((len(words), len(mark) + len(at) + 1), np.uint8)
    m[:, : len(mark)] = np.frombuffer(mark, np.uint8)
    m[:, len(mark) : -1] = np.where(at < sizes[:, None], b[np.minimum(starts[:, None] + at, len(b) - 1)], 0)
    return m, sizes + len(mark)


def char_bytes(first: np.ndarray) -> np.ndarray:
    """Length of the UTF-8 character that begins with each byte; 0 for a continuation byte."""
    return np.select([first < 0x80, first < 0xC0, first < 0xE0, first < 0xF0], [1, 0, 2, 3], 4)


def matches(trie: PieceTrie, m: np.ndarray, lengths: np.ndarray, start: int, rows: np.ndarray):
    """(rows, end, piece ids) for every length of a piece that begins at ``start`` in the given rows."""
    node = np.zeros(len(rows), np.int32)
    for j in range(start, min(start + trie.longest, m.shape[1] - 1)):
        inside = j < lengths[rows]
        rows, node = rows[inside], node[inside]
        child = trie.base[node] + m[rows, j]
        ok = (trie.check[child] == node) & (trie.base[node] > 0)
        rows, node = rows[ok], child[ok]
        if not len(rows):
            return
        ids = trie.piece[node]
        is_piece = ids >= 0
        if is_piece.any():
            yield rows[is_piece], j + 1, ids[is_piece]
