"""Token-ID output: Parquet files of id lists that can be read in part.

Documents are cut into id ranges and sorted, each range is encoded where it lies and written as
one file, so files in name order are the corpus in document order.  A row holds doc_id, the range
(block), the token offset in it, the number of tokens and the ids.  The ids column is dictionary coded
(the vocabulary fits one dictionary page, an id takes two bytes or less); doc_id and offset are
ascending and delta coded.  Row groups and pages are small enough for the page index to skip most of a
file: metadata reads touch no id page, reads by doc_id touch the pages of those documents.

With a tokenizer that lower-cases, drops white space and splits letters from other signs, a text's ids are
those of its chunks between ASCII white space, one after the other.  Whether a model is of that kind is read from its
normalizer, pre-tokenizer and post-processor (``by_chunks``).  A worker then keeps the ids of chunks it has met, up to
``CACHE`` of them, from task to task, and texts that may hold the string of a special token go to the library whole.
With any other model all texts go to the library whole.

Defined results: a null or empty text has only the end id; repeated rows are each written, side by
side; null ids come first; an empty table gives an empty store; extra columns are not written.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlens.llm import bytescan as bs
from hourlens.llm.common import block_offsets, partitions, small_batches
from hourlens.session import work_dir

CACHE = 800_000
SCHEMA = "doc_id {id}, block int, start long, n_tokens int, ids array<int>"
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",        # delta coding where no dictionary is used
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start": "false",
    "parquet.block.size": str(16 << 20),            # bytes of a row group
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}


ASCII_WORD = np.zeros(256, bool)
ASCII_WORD[48:58] = ASCII_WORD[65:91] = ASCII_WORD[97:123] = True
SIGN = np.zeros(256, bool)              # ASCII signs; an apostrophe can belong to what follows it
SIGN[33:127] = ~ASCII_WORD[33:127]
SIGN[39] = False


def set_apart(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space between each word of Latin-1 letters or digits and the ASCII signs that close it.

    A token always ends there, so the ids stay the same while the chunks to remember become
    fewer.  White space or the text's end has to follow the signs: then nothing joins them."""
    n = len(buf)
    if n < 2:
        return buf, bounds
    sign, letter = SIGN[buf], ASCII_WORD[buf]
    # U+00C0 to U+00FF are letters but for the signs of multiplication and division
    letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    turn = sign[1:] & letter[:-1]
    inner = bounds[(bounds > 0) & (bounds < n)]
    turn[inner - 1] = False                     # a text's first character closes no word
    at = np.flatnonzero(turn) + 1
    other = np.append(np.flatnonzero(~sign), n)             # where a run of signs may end
    after = other[np.searchsorted(other, at)]
    limit = bounds[np.searchsorted(bounds, at, "right")]    # the end of the text it is in
    closed = (after >= limit) | bs.SPACE[buf[np.minimum(after, n - 1)]]
    at = at[closed]
    return np.insert(buf, at, 32), bounds + np.searchsorted(at, bounds)


# fixed values: what a model of the known kind does to a text before its words are merged
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


def by_chunks(model: dict) -> bool:
    """Are a text's ids those of its parts between white space?  True only for what is known to be so."""
    return (model.get("normalizer") == {"type": "Sequence", "normalizers": NORMALIZERS}
            and model.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": PRE_TOKENIZERS}
            and model.get("post_processor") is None and model.get("truncation") is None
            and model.get("padding") is None and not model["model"].get("dropout"))


class Encoder:
    """Ids of many texts at once; chunks met before are looked up."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model)
        self.chunked = by_chunks(json.loads(model))
        if not self.chunked:
            self.special = b""
            return
        # what every special token starts with; texts that hold it go to the library as they are
        special = [t["content"].encode() for t in json.loads(model).get("added_tokens", [])]
        self.special = os.path.commonprefix(special)[:2] if special else b""
        if special and not self.special:
            raise ValueError("special tokens must share their first character")
        self._forget()

    def _forget(self):
        self.slots: dict[bytes, int] = _Slots()
        self.ids, self.used = np.empty(1 << 20, np.int32), 0
        self.at = self.size = np.empty(0, np.int64)

    def _learn(self):
        """Encode the chunks seen for the first time."""
        new = [c.decode() for c in self.slots.new]
        self.slots.new.clear()
        if not new:
            return
        # words of letters, joined by spaces, are one pre-token each: one call encodes them all
        letters = np.fromiter(map(str.isalpha, new), bool, len(new))
        plain, rest = np.flatnonzero(letters), np.flatnonzero(~letters)
        joined = self.model.encode(" ".join([new[k] for k in plain]), add_special_tokens=False)
        words = np.array(joined.word_ids, np.int64)
        counts = np.bincount(words, minlength=len(plain)) if len(words) else np.zeros(len(plain), np.int64)
        ids = np.array(joined.ids, np.int32)
        if len(counts) != len(plain) or not (counts > 0).all():   # some letter is none to the library
            plain, rest = np.empty(0, np.int64), np.arange(len(new))
            counts, ids = np.empty(0, np.int64), np.empty(0, np.int32)
        others = [e.ids for e in self.model.encode_batch_fast(
            [new[k] for k in rest], add_special_tokens=False)]
        order = np.concatenate([plain, rest])
        laid = np.concatenate([counts, np.array([len(o) for o in others], np.int64)])
        flat = np.concatenate([ids, np.array([i for o in others for i in o], np.int32)])
        size, at = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        size[order], at[order] = laid, self.used + np.cumsum(laid) - laid
        end = self.used + int(size.sum())
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.empty(2 * end - self.used, np.int32)])
        self.ids[self.used:end] = flat
        self.at = np.concatenate([self.at, at])
        self.size = np.concatenate([self.size, size])
        self.used = end

    def _with_special(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts that may hold the string of a special token."""
        if not self.special or len(buf) < len(self.special):
            return np.empty(0, np.int64)
        hit = np.ones(len(buf) - len(self.special) + 1, bool)
        for i, c in enumerate(self.special):
            hit &= buf[i:len(hit) + i] == c
        return np.unique(np.searchsorted(bounds, np.flatnonzero(hit), "right") - 1)

    def encode(self, buf: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and where each text begins (one more than texts); ``end`` closes every text."""
        if not self.chunked:
            raw = [buf[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]
            found = [e.ids for e in self.model.encode_batch_fast(raw, add_special_tokens=False)]
            cut = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)])
            flat = np.array([i for f in found for i in f], np.int32)
            return np.insert(flat, cut[1:], end).astype(np.int32), cut + np.arange(len(cut))
        if len(self.slots) > CACHE:
            self._forget()
        spaced, cut = set_apart(buf, bounds)
        # the model lower-cases anyway; only before a combining mark does the order matter
        small, whole = bs.LOWER[spaced], {}
        marks = np.flatnonzero((spaced == 0xCC) | (spaced == 0xCD))
        for k in np.unique(np.searchsorted(cut, marks, "right") - 1):
            small[cut[k]:cut[k + 1]] = spaced[cut[k]:cut[k + 1]]
        for k in self._with_special(spaced, cut):
            raw = buf[bounds[k]:bounds[k + 1]].tobytes().decode()
            whole[k] = np.array(self.model.encode(raw, add_special_tokens=False).ids, np.int32)
            small[cut[k]:cut[k + 1]] = 32
        names, words, offs = bs.split_words(small, cut)
        names = names.cast(pa.large_binary()).to_pylist()
        slots = np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))[words]
        counts = np.diff(offs)
        self._learn()
        at, size = self.at[slots], self.size[slots]
        places = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.repeat(at - places[:-1], size) + np.arange(places[-1])]
        cut = places[np.concatenate([[0], np.cumsum(counts)])]
        if whole:
            pieces = [whole.get(k, flat[cut[k]:cut[k + 1]]) for k in range(len(counts))]
            cut = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
            flat = np.concatenate(pieces)
        return np.insert(flat, cut[1:], end).astype(np.int32), cut + np.arange(len(cut))


_ENCODERS: dict[str, Encoder] = {}      # one per model: a worker's later tasks know its words


def encoder_for(model: str) -> Encoder:
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = Encoder(model)
    return _ENCODERS[model]


class _Slots(dict):
    """Chunk to slot number; a new chunk gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk):
        self[chunk] = slot = len(self)
        self.new.append(chunk)
        return slot


def write_tokens(docs: DataFrame, path: str, model: str, end: int = 1, layout=LAYOUT) -> None:
    """Encode ``docs`` with the tokenizer in the JSON text ``model`` and write them to ``path``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]

    def encode(batches):
        encoder, before = encoder_for(shared.value), 0
        for batch in batches:
            buf, bounds = bs.buffers(batch["text"])
            for i, j in bs.groups(bounds):
                ids, offs = encoder.encode(buf[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], end)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(i, j - i), pa.array(before + offs[:-1], pa.int64()),
                     pa.array(np.diff(offs), pa.int32()), bs.listed(offs, ids, pa.int32())],
                    ["doc_id", "start", "n_tokens", "ids"])
                before += int(offs[-1])

    laid = docs.select("doc_id", "text").repartitionByRange(
        partitions(spark), "doc_id").sortWithinPartitions("doc_id")
    rows = laid.mapInArrow(encode, f"doc_id {kind}, start long, n_tokens int, ids array<int>")
    rows.select("doc_id", F.spark_partition_id().alias("block"), "start", "n_tokens", "ids").write.options(
        **layout).parquet(path)


def read_metadata(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens, without reading an id page."""
    rows = spark.read.schema(SCHEMA.format(id=kind)).parquet(path).select(
        "doc_id", "block", "start", "n_tokens")
    before = block_offsets(rows, F.col("n_tokens"))         # one row per file
    return rows.join(F.broadcast(before), "block").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), F.col("n_tokens").cast("long"))


def read_tokens(spark: SparkSession, path: str, low=None, high=None, kind: str = "long") -> DataFrame:
    """doc_id, block, start (in the block), n_tokens, ids of the documents low <= doc_id <= high."""
    rows = spark.read.schema(SCHEMA.format(id=kind)).parquet(path)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows


def checksums(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, all from the files."""
    rows = read_tokens(spark, path, kind=kind)
    before = block_offsets(rows, F.col("n_tokens"))

    def sums(batches):
        for batch in batches:
            ids = batch["ids"]
            values = ids.values.to_numpy().astype("<u4", copy=False)
            places = ids.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["block"], batch["start"],
                 pa.array(np.diff(places), pa.int64()),
                 pa.array([zlib.crc32(values[a:b]) for a, b in zip(places[:-1], places[1:])], pa.int64())],
                ["doc_id", "block", "start", "n_tokens", "ids_crc32"])

    summed = rows.select("doc_id", "block", "start", "ids").mapInArrow(
        sums, f"doc_id {kind}, block int, start long, n_tokens long, ids_crc32 long")
    return summed.join(F.broadcast(before), "block").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_report(docs: DataFrame, model: str, end: int = 1) -> DataFrame:
    """Write a store of ``docs`` under the shared folder and report what its files hold."""
    path = work_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, model, end)
    return checksums(docs.sparkSession, path, dict(docs.dtypes)["doc_id"])
