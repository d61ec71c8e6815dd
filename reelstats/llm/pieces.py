"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Text is encoded as the library does for a unigram model without normalisation:
a leading space is added, spaces become the marker U+2581, and the path of
pieces with the largest sum of log scores is taken; a character that no piece
covers costs the smallest score minus ten and is written as its UTF-8 bytes'
pieces.  Decoding joins the pieces, turns byte pieces into bytes and markers
into spaces and drops the leading space, so a text without the marker character
comes back exactly.

No piece of the vocabularies used joins another character to a following
marker, so the best path passes every such place: texts are cut there and each
distinct chunk of a slice is segmented once, all chunks of a length together
(one numpy step per byte and trie level).  A vocabulary with such pieces is
handled too; its texts are then single chunks.

A vocabulary file whose scores are merge ranks (a BPE file) has no log scores;
they follow from the rank by Zipf's law, a fixed rule, nothing is trained.

Defined results: null is empty text, which has no pieces; of paths of equal score
the one that the library takes stands; texts of any length are encoded whole;
repeated rows give repeated results; an empty table gives no rows; other columns
never matter.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm.words import slices, texts_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CODED = ("doc_id long, n_chars long, n_tokens long, n_byte_tokens long, ids_crc32 long, score double, "
         "decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """Pieces of a model file and the double array over their UTF-8 bytes."""

    pieces: list[str]
    scores: np.ndarray        # float32, by id
    bytes_at: np.ndarray      # id of each byte's piece, -1 without
    unknown: int
    base: np.ndarray          # double array: child t = base[s] + byte + 1, valid iff check[t] == s
    check: np.ndarray
    piece_of: np.ndarray      # id of the piece that ends in a state, -1 without
    longest: int              # bytes of the longest piece
    cut_at_marks: bool


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Log probabilities 1/(rank+1), normalised."""
    p = 1.0 / (np.asarray(ranks, np.float64) + 1)
    return np.log(p / p.sum())


def double_array(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Double array of sorted distinct keys, by first fit from the lowest free cell."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for key, value in zip(keys, values):
        node = 0
        for byte in key:
            nxt = children[node].get(byte)
            if nxt is None:
                nxt = children[node][byte] = len(children)
                children.append({})
                ends.append(-1)
            node = nxt
        ends[node] = value
    size = 2 * len(children) + 600
    base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = bytearray(size)
    used[0] = 1
    place, free, queue = {0: 0}, 1, [0]
    for node in queue:
        state = place[node]
        piece[state] = ends[node]
        labels = sorted(children[node])
        if not labels:
            continue
        while used[free]:
            free += 1
        at = free
        while True:
            b = at - labels[0] - 1
            if b >= 0 and not any(used[b + c + 1] for c in labels):
                break
            at = used.index(0, at + 1)
        base[state] = b
        for c in labels:
            used[b + c + 1] = 1
            check[b + c + 1] = state
            place[children[node][c]] = b + c + 1
            queue.append(children[node][c])
    return base, check, piece


def vocabulary(path: str | None = None, scores: np.ndarray | None = None) -> Vocabulary:
    """Read a model file; ``scores`` (by id) replaces those of the file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)
                                          or sp.is_unused(i))]
    own = np.array([sp.get_score(i) for i in range(n)])
    if scores is None and np.array_equal(own, np.round(own)):  # merge ranks: whole numbers
        scores = np.zeros(n)
        scores[np.array(normal)[np.argsort(-own[normal], kind="stable")]] = zipf_scores(np.arange(len(normal)))
    bytes_at = np.full(256, -1, np.int64)
    for i in range(n):
        if sp.is_byte(i):
            bytes_at[int(pieces[i][3:5], 16)] = i
    order = sorted(normal, key=lambda i: pieces[i].encode())
    keys = [pieces[i].encode() for i in order]
    base, check, piece = double_array(keys, order)
    joins = re.compile(f"[^{MARK}]{MARK}")
    return Vocabulary(pieces, np.asarray(own if scores is None else scores, np.float32), bytes_at, sp.unk_id(),
                      base, check, piece, max(map(len, keys)), not any(joins.search(pieces[i]) for i in normal))


def char_lengths(rows: np.ndarray) -> np.ndarray:
    """UTF-8 length of the character that starts at each byte, 0 inside a character."""
    out = np.ones(rows.shape, np.int8)
    out[rows >= 0xC0] = 2
    out[rows >= 0xE0] = 3
    out[rows >= 0xF0] = 4
    out[(rows & 0xC0) == 0x80] = 0
    return out


def segment(chunks: list[bytes], v: Vocabulary) -> tuple[list[np.ndarray], np.ndarray]:
    """Best path of every chunk: piece ids (byte pieces for unknown characters) and its score."""
    out: list = [None] * len(chunks)
    total = np.zeros(len(chunks), np.float32)
    size = np.array([len(c) for c in chunks])
    used = v.scores[v.piece_of[v.piece_of >= 0]]
    unknown_score = np.float32(used.min() - UNKNOWN_PENALTY)
    # the double array is padded so that every child index can be looked up
    check = np.concatenate([v.check, np.full(512, -1, np.int32)])
    for length in np.unique(size):
        members = np.flatnonzero(size == length)
        if length == 0:
            for m in members:
                out[m] = np.zeros(0, np.int64)
            continue
        step = max(1, (1 << 20) // int(length))
        for at in range(0, len(members), step):
            part = members[at:at + step]
            rows = np.frombuffer(b"".join(chunks[m] for m in part), np.uint8).reshape(len(part), length)
            paths = viterbi(rows, v, check, unknown_score)
            for m, (ids, score) in zip(part, paths):
                out[m], total[m] = ids, score
    return out, total


def viterbi(rows: np.ndarray, v: Vocabulary, check: np.ndarray, unknown_score: np.float32):
    """Paths of chunks of one length; rows: (chunks, bytes)."""
    n, length = rows.shape
    width = char_lengths(rows)
    best = np.full((n, length + 1), -np.inf, np.float32)
    came = np.zeros((n, length + 1), np.int32)
    piece = np.full((n, length + 1), -1, np.int64)
    best[:, 0] = 0
    for i in range(length):
        row = np.flatnonzero(width[:, i] > 0)
        if not len(row):
            continue
        here, w = best[row, i], width[row, i].astype(np.int64)
        single = np.zeros(len(row), bool)
        state, alive = np.zeros(len(row), np.int64), np.arange(len(row))
        for j in range(i, min(length, i + v.longest)):
            nxt = v.base[state] + rows[row[alive], j].astype(np.int64) + 1
            ok = check[nxt] == state
            state, alive = nxt[ok], alive[ok]
            if not len(alive):
                break
            ids = v.piece_of[state]
            hit = ids >= 0
            if not hit.any():
                continue
            who, ids = alive[hit], ids[hit]
            score = here[who] + v.scores[ids]
            better = score > best[row[who], j + 1]
            who, ids, score = who[better], ids[better], score[better]
            best[row[who], j + 1], came[row[who], j + 1], piece[row[who], j + 1] = score, i, ids
            single[alive[hit][w[alive[hit]] == j + 1 - i]] = True
        lone = np.flatnonzero(~single)
        if len(lone):
            end = np.minimum(i + w[lone], length)
            score = here[lone] + unknown_score
            better = score > best[row[lone], end]
            lone, end, score = lone[better], end[better], score[better]
            best[row[lone], end], came[row[lone], end], piece[row[lone], end] = score, i, -1
    for r in range(n):
        ids, at = [], length
        while at > 0:
            start = came[r, at]
            if piece[r, at] >= 0:
                ids.append(piece[r, at])
            else:
                as_bytes = v.bytes_at[rows[r, start:at]]
                ids.extend(as_bytes[::-1] if (as_bytes >= 0).all() else [v.unknown])
            at = start
        yield np.array(ids[::-1], np.int64), best[r, length]


def chunks_of(text: str, v: Vocabulary) -> list[str]:
    """Marked text cut before every marker that follows another character."""
    if not text:
        return []
    marked = MARK + text.replace(" ", MARK)
    return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", marked) if v.cut_at_marks else [marked]


class PieceCoder:
    """Encodes and decodes slices of texts."""

    def __init__(self, v: Vocabulary):
        self.v = v
        raw = [p.replace(MARK, " ").encode() for p in v.pieces]
        for byte, i in enumerate(v.bytes_at):
            if i >= 0:
                raw[i] = bytes([byte])
        raw[v.unknown] = "⁇".encode()
        self.raw = raw
        self.is_byte = np.zeros(len(raw), bool)
        self.is_byte[v.bytes_at[v.bytes_at >= 0]] = True

    def chunked(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All chunks of the texts in sequence, and the row offsets."""
        plain = self.v.cut_at_marks and not pc.any(pc.match_substring_regex(texts, f"^ | $|  |{MARK}|^$")).as_py()
        if plain:  # single inner spaces only: every chunk is a marker and what lies between two spaces
            lists = pc.split_pattern(texts, " ")
            flat = pc.binary_join_element_wise(pa.scalar(MARK), lists.flatten(), "")
            return flat, lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        rows = [chunks_of(t, self.v) for t in texts.to_pylist()]
        return (pa.array([c for r in rows for c in r], pa.string()),
                np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]))

    def encode(self, texts: pa.Array):
        """Ids of all texts, flat; row offsets; score of each row's path."""
        flat, offsets = self.chunked(texts)
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        paths, scores = segment([c.encode() for c in coded.dictionary.to_pylist()], self.v)
        counts = np.array([len(p) for p in paths], np.int64)
        ids = np.concatenate(paths) if paths else np.zeros(0, np.int64)
        starts = np.cumsum(counts) - counts
        size = counts[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        gathered = ids[np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[codes], size)]
        sums = np.concatenate([[0.0], np.cumsum(scores[codes].astype(np.float64))])
        return gathered, ends[offsets], sums[offsets[1:]] - sums[offsets[:-1]]

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def code_rows(v: Vocabulary):
    def run(batches):
        import hashlib
        coder = PieceCoder(v)
        for batch in slices(batches, max_bytes=4 << 20):
            texts = texts_of(batch)
            ids, offsets, scores = coder.encode(texts)
            small = ids.astype("<u4")
            bounds = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
            as_list = ids.tolist()
            byte_sums = np.concatenate([[0], np.cumsum(coder.is_byte[ids])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pc.cast(pc.utf8_length(texts), pa.int64()),
                 pa.array(np.diff(offsets)), pa.array(np.diff(byte_sums[offsets])),
                 pa.array([zlib.crc32(small[a:b]) for a, b in bounds], pa.int64()), pa.array(scores),
                 pa.array([hashlib.sha256(coder.decode(as_list[a:b]).encode()).hexdigest() for a, b in bounds])],
                names=["doc_id", "n_chars", "n_tokens", "n_byte_tokens", "ids_crc32", "score", "decoded_sha256"])
    return run


def encode_and_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per document: the size, CRC and score of its encoding, and the digest of what that decodes to."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(code_rows(vocabulary(path)), CODED)
