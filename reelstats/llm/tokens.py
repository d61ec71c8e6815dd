"""Token ids of whole texts with the tokenizers library, by distinct chunk.

The tokenizer lower-cases, splits at white space and between letters and marks,
and merges inside words only: its normaliser works character by character (NFC
composes nothing with a space) and its split pattern matches no white space.
Encoding every distinct chunk of a slice once and gathering the ids therefore
gives the library's ids of the whole text; the tests compare both on whole
tables, on odd texts and on random ones.  A tokenizer file with another
normaliser, split pattern or kind of special tokens encodes whole texts.

Tasks receive the file's text, not its path.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reelstats.llm.words import Words

END_ID = 1
TOKEN_SLICE = 16 << 20  # bytes of text encoded at once


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def file_text(path: str | None = None) -> str:
    """The tokenizer file as text, read where the job is planned."""
    with open(path or default_path(), encoding="utf-8") as f:
        return f.read()


# The normaliser and the split pattern for which chunks may be encoded apart.
CHUNKED = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def may_chunk(spec: dict) -> bool:
    """Do distinct chunks of a text give the ids of the whole text with this tokenizer?"""
    special = all(t["content"].startswith("<|") and not (t["single_word"] or t["lstrip"] or t["rstrip"])
                  for t in spec["added_tokens"])
    return special and spec["model"].get("end_of_word_suffix") == "</w>" and all(
        spec[k] == v for k, v in CHUNKED.items())


def vocab_size(text: str) -> int:
    spec = json.loads(text)
    return len({*spec["model"]["vocab"], *(t["content"] for t in spec["added_tokens"])})


def id_kind(vocab_size: int) -> str:
    """Storage type of ids: two bytes while the vocabulary allows it."""
    return "<u2" if vocab_size <= 1 << 16 else "<u4"


class TokenEncoder:
    """Encodes slices of texts; one instance per task."""

    GROUP, CALL = 100, 20_000  # words joined into one string; words of one library call
    # A letter and a mark after it are separate words for the tokenizer, provided that the letter
    # stays one letter when it is normalised: these all do, U+0130 and many composed letters do not.
    CUT = r"([a-zA-ZÀ-ÖØ-öø-ÿ])([.,!?;:%&#$*()])"

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(text)
        self.chunked = may_chunk(json.loads(text))
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.is_end = np.zeros(self.vocab_size, bool)
        self.is_end[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text, flat, and the number of ids of each."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def words_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters only, many to a library string: each word's last id ends a word."""
        groups = [words[a:a + self.GROUP] for a in range(0, len(words), self.GROUP)]
        flat, counts = self.library([" ".join(g) for g in groups])
        ends = np.flatnonzero(self.is_end[flat])
        per_group = np.add.reduceat(self.is_end[flat], np.cumsum(counts) - counts, dtype=np.int64)
        if (per_group != [len(g) for g in groups]).any():  # a letter that falls apart when normalised
            return self.library(words)
        return flat, np.diff(np.append(-1, ends))

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of every distinct chunk: flat, and each chunk's start and number."""
        letters = pc.utf8_is_alpha(chunks).to_numpy(zero_copy_only=False)
        start, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        flat, at = [], 0
        for members, encode in ((np.flatnonzero(letters), self.words_ids), (np.flatnonzero(~letters), self.library)):
            for a in range(0, len(members), self.CALL):
                part = members[a:a + self.CALL]
                ids, counts = encode(chunks.take(pa.array(part)).to_pylist())
                start[part], size[part] = at + np.cumsum(counts) - counts, counts
                flat.append(ids)
                at += len(ids)
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), start, size

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the row offsets, by the library alone."""
        ids, counts = self.library(texts.to_pylist())
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def by_chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same with every distinct chunk encoded once."""
        # fewer distinct chunks, the same ids; texts that may hold special tokens stay as they are
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), self.CUT, r"\1 \2")
        words = Words(pc.if_else(pc.match_substring(texts, "<|"), texts, plain))
        flat, start, counts = self.chunk_ids(words.vocab)
        size = counts[words.codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.arange(ends[-1]) + np.repeat(start[words.codes] - ends[:-1], size)]
        return ids, ends[words.offsets]

    def encode(self, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, each followed by ``end_id``; and the row offsets."""
        ids, per_doc = self.by_chunks(texts) if self.chunked else self.whole(texts)
        if end_id is None:
            return ids, per_doc
        n = len(texts)
        out = np.empty(len(ids) + n, np.uint32)
        ends = per_doc[1:] + np.arange(n)
        body = np.ones(len(out), bool)
        body[ends] = False
        out[body], out[ends] = ids, end_id
        return out, per_doc + np.arange(n + 1)
