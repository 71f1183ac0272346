"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Leaf i of a word's segment tree holds the rank of the pair that starts at
symbol i, together with i, so the root is the leftmost pair of lowest rank.  A
merge changes at most three leaves (the merged pair, the one before and the
one after); each change is a point update along one path to the root.  Merging
ends when the root holds no pair.  Short words are rows of one array and step
together, each along its own tree; long words have a tree of their own.

Normalization and the split into words are those of the tokenizer file, done
by the library's own components (for ASCII pieces by an equal pattern).  Text
is cut at ASCII white space, which neither step can cross, and a worker
remembers a bounded number of pieces and words it has encoded."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.iinfo(np.int64).max
#: Words up to this many bytes share arrays.
SHORT = 64
#: Leaves of all trees that step together; bounds a task's memory.
LEAVES = 1 << 19
#: Pieces, and words, that a Python worker remembers.
REMEMBERED = 1_000_000
ASCII_WORD = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+")


class Bpe:
    """Encoder and decoder for one tokenizer file: byte-level symbols, BPE
    merges, an end-of-word suffix, no decoder of its own."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.normalizer = Tokenizer.from_file(path).normalizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        suffix, vocab = model["end_of_word_suffix"] or "", model["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.names = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())
        self.base = 1 << len(names).bit_length()
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.pairs = dict(zip(keys.tolist(), zip(range(len(keys)), made.tolist())))
        # Symbol of each byte inside a word, and at its end.
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + suffix] for c in alphabet], np.int64)
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    # -- one step for many short words ----------------------------------------
    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs; rank NONE where there is no merge."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NONE), self.made[at]

    def merge_rows(self, words: list[bytes], width: int) -> list[bytes]:
        """Serialized ids of words of at most `width` bytes (a power of two)."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[flat]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[flat[last]]
        sym = np.full((n, width + 1), -1, np.int64)
        sym[:, :width][np.arange(width) < sizes[:, None]] = symbols
        after = np.tile(np.arange(1, width + 2), (n, 1))  # the next symbol's position
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int64)
        rank, _ = self.look_up(sym[:, :-1], sym[:, 1:])
        tree[:, width:] = np.where(rank == NONE, NONE, rank * width + np.arange(width))
        half = width
        while half > 1:  # each node is the least of its two children
            tree[:, half // 2:half] = np.minimum(tree[:, half:2 * half:2], tree[:, half + 1:2 * half:2])
            half //= 2

        live = np.flatnonzero(tree[:, 1] != NONE)
        while len(live):
            i = tree[live, 1] % width  # the root: lowest rank, then leftmost
            j = after[live, i]
            k = after[live, j]
            h = before[live, i]
            _, merged = self.look_up(sym[live, i], sym[live, j])
            sym[live, i], sym[live, j] = merged, -1
            after[live, i], before[live, np.minimum(k, width)] = k, i
            rank, _ = self.look_up(np.concatenate([merged, np.where(h >= 0, sym[live, h], -1)]),
                                   np.concatenate([np.where(k < width, sym[live, np.minimum(k, width)], -1), merged]))
            m = len(live)
            own, left = rank[:m], rank[m:]
            left_at = np.where(h >= 0, h, j)  # without a left neighbour: the emptied leaf again
            tree[live, width + j] = NONE
            tree[live, width + i] = np.where(own == NONE, NONE, own * width + i)
            tree[live, width + left_at] = np.where((h < 0) | (left == NONE), NONE, left * width + h)
            node = np.concatenate([i, j, left_at]) + width
            who = np.concatenate([live, live, live])
            for _ in range(width.bit_length() - 1):  # point updates up to the root
                node = node // 2
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
            live = live[tree[live, 1] != NONE]
        kept = sym >= 0
        ends = 4 * np.cumsum(kept.sum(axis=1))
        data = sym[kept].astype("<i4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    # -- a long word -----------------------------------------------------------
    def merge_long(self, word: bytes) -> bytes:
        """The same for one word of any length."""
        n = len(word)
        width = 1 << (n - 1).bit_length()
        raw = np.frombuffer(word, np.uint8)
        sym = self.inner[raw].tolist()
        sym[-1] = int(self.final[raw[-1]])
        after, before, base, pairs = list(range(1, n + 1)), list(range(-1, n - 1)), self.base, self.pairs
        tree = [NONE] * (2 * width)

        def leaf(i: int) -> int:
            j = after[i]
            pair = pairs.get(sym[i] * base + sym[j]) if j < n else None
            return NONE if pair is None else pair[0] * width + i

        for i in range(n - 1):
            tree[width + i] = leaf(i)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != NONE:
            i = tree[1] % width
            j = after[i]
            sym[i], sym[j] = pairs[sym[i] * base + sym[j]][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            changed = [(j, NONE), (i, leaf(i))]
            if before[i] >= 0:
                changed.append((before[i], leaf(before[i])))
            for at, value in changed:
                node = width + at
                tree[node] = value
                while node > 1:
                    node //= 2
                    least = min(tree[2 * node], tree[2 * node + 1])
                    if tree[node] == least:
                        break
                    tree[node] = least
        return np.array([x for x in sym if x >= 0], "<i4").tobytes()

    # -- texts -------------------------------------------------------------------
    def split_piece(self, piece: bytes) -> list[bytes]:
        """The words of a piece, normalized."""
        if piece.isascii():
            return ASCII_WORD.findall(piece.lower())
        text = self.normalizer.normalize_str(piece.decode())
        return [w.encode() for w, _ in self.splitter.pre_tokenize_str(text)]

    def learn(self, pieces: list[bytes]) -> None:
        """Encodes pieces that the worker doesn't remember."""
        if len(self.pieces) + len(pieces) > REMEMBERED:
            self.pieces.clear()
        split = list(map(self.split_piece, pieces))
        new = {w for words in split for w in words}
        if len(self.words) + len(new) > REMEMBERED // 2:
            self.words.clear()
        classes: dict[int, list[bytes]] = {}
        for w in new.difference(self.words):
            classes.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(w)
        for width, words in classes.items():
            if width > SHORT:
                self.words.update((w, self.merge_long(w)) for w in words)
                continue
            for at in range(0, len(words), LEAVES // width):
                some = words[at:at + LEAVES // width]
                self.words.update(zip(some, self.merge_rows(some, width)))
        get = self.words.__getitem__
        self.pieces.update((p, b"".join(map(get, words))) for p, words in zip(pieces, split))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Serialized ids (little-endian, 4 bytes) of whole texts; special
        tokens in a text are recognised as such."""
        split = []
        for t in texts:
            raw = (t or "").encode()
            if any(s in raw for s in self.special):
                split.append([p for part in self.cut.split(raw) for p in ([part] if part in self.special else part.split())])
            else:
                split.append(raw.split())
        wanted = set().union(*split)
        new = wanted.difference(self.pieces)
        if len(self.pieces) + len(new) > REMEMBERED:
            self.pieces.clear()
            new = wanted
        self.learn(list(new.difference(self.special)))
        self.pieces.update((s, np.array([i], "<i4").tobytes()) for s, i in self.special.items())
        get = self.pieces.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def decode(self, ids: pa.ListArray) -> pa.StringArray:
        """The tokens of each list of ids joined by one space, as a tokenizer
        without a decoder of its own does; special tokens stay."""
        tokens = pa.ListArray.from_arrays(ids.offsets, self.names.take(ids.values))
        return pc.binary_join(tokens, " ")


def byte_alphabet() -> list[str]:
    """Byte-level symbols: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    names = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [names[b] for b in range(256)]


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in encoded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One encoder per Python worker and file."""
    return Bpe(path)


#: Bytes of text encoded at a time.
CHUNK_BYTES = 4 * 2**20


def chunks(texts: list[str | None]):
    """Slices of `texts` of about CHUNK_BYTES each."""
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK_BYTES:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): ids of every whole text and the text decoded
    from them.  NULL and empty texts give no ids and an empty string.  `path`
    names the tokenizer file on every machine."""

    def run(batches):
        bpe = load(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                ids = id_lists(bpe.encode_batch(texts[a:b]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids, bpe.decode(ids)],
                                                 names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")
