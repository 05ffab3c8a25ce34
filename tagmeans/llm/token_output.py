"""Token-id output in a static range asymmetric numeral system (rANS).

File format (version 1): a Parquet folder of blocks. Each row is one block that
can be decoded on its own: ``part`` and ``block`` (its place: parts are ranges
of ascending ids), ``docs`` (id, place of the first id within the part, number
of ids of each document), ``n`` (ids in the block) and
``data``, the coded bytes. A block holds whole documents:

    magic "RA1\\0", lanes u32, steps u32, n u32, crc32 of the ids u32, segments u32
    for each segment (checkpoint): words u32, the lanes' states u64
    for each segment: its words u32, in reading order

All blocks share one frequency table, made from the counts of all ids and
stored beside them (``table`` rows in a second folder). Id ``i`` of a segment
belongs to lane ``i % lanes``; each segment of ``lanes * steps`` ids starts from
its own states, so all segments of a block are decoded side by side.

Defined results: a null or empty text is one end id; documents stand in ascending
(id, ids) order, a null id first; repeated rows are written as often as they
stand in the table; a text of any length is encoded whole (its ids must fit one row); further
columns are not written; an empty table gives an empty folder.
"""

from __future__ import annotations

import re
import string
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.checkpoint import delete_copy, ensure_checkpoint_dir
from .common import slices, table

END = 0
MAGIC = b"RA1\0"
#: Bits of the quantised frequencies' sum, lanes of a segment, steps of a lane in a
#: segment, ids that fill a block.
SCALE, LANES, STEPS, BLOCK = 20, 256, 512, 1 << 20
LOW = np.uint64(1 << 31)
#: Distinct words whose ids a Python worker remembers (some 50 bytes each).
REMEMBERED = 800_000
#: New words that are encoded in one text; the library takes longer for each in long texts.
LEARNED = 100
#: Characters whose words are looked up together.
AT_ONCE = 6 << 20

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_PUNCTUATION = string.punctuation
#: A letter below U+0250.
_LETTER = r"[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]"


class Pieces:
    """Ids of whole texts by the tokenizers library, with a memory for frequent words.

    Byte-level BPE splits a text at least before each space that stands between
    two characters that aren't white space; so a text is cut there, and each
    distinct piece is encoded once. A word after a letter of which punctuation
    follows is looked up apart from that, as the library splits there in any case.
    What is remembered are Arrow strings (``known``) and, side by side, their ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.known = pa.array([], pa.string())
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.special = "|".join(re.escape(t.content) for t in self.encoder.get_added_tokens_decoder().values())
        # ids of tokens that begin with a space (written so in a byte-level vocabulary)
        vocabulary = self.encoder.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t[0] == "\u0120"]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.encoder.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in got]

    def _whole(self, pieces: list[str], memory: dict[str, bytes]) -> list[bytes]:
        """Ids of each piece as a text of its own."""
        new = list({w for w in pieces if w not in memory})
        memory.update(zip(new, self._ids(new)))
        return [memory[w] for w in pieces]

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " " and each word (without a space within), and how many each has. Many are encoded
        in one text; there each token that begins with a space begins a word."""
        size, ids = [], []
        for a in range(0, len(words), LEARNED):
            part = words[a:a + LEARNED]
            got = np.frombuffer(self._ids([" " + " ".join(part)])[0], np.uint32)
            first = np.flatnonzero(self.spaced[got])
            if len(first) != len(part):
                raise ValueError("the vocabulary isn't a byte-level one")
            size.append(np.diff(np.r_[first, len(got)]))
            ids.append(got)
        return np.concatenate([np.zeros(0, np.int64), *size]), np.concatenate([np.zeros(0, np.uint32), *ids])

    def _cut_tails(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, pa.DictionaryArray]:
        """The words without the punctuation that follows a letter, the places of those that
        had such, and it."""
        core = pc.utf8_rtrim(words, _PUNCTUATION)
        cut = pc.and_(pc.less(pc.binary_length(core), pc.binary_length(words)),
                      pc.match_substring_regex(core, _LETTER + r"\z"))
        if self.special:
            cut = pc.and_(cut, pc.invert(pc.match_substring_regex(words, self.special)))
        at = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        tails = pc.replace_substring_regex(words.filter(cut), r"(?s)\A.*" + _LETTER, "")
        return pc.if_else(cut, core, words), at, tails.dictionary_encode()

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids " " and each word (without a space within) have, and the ids."""
        core, at, tails = self._cut_tails(words)
        coded = core.dictionary_encode()
        # the words of the slice are fewer than those known, so they are what is hashed
        found = pc.index_in(self.known, coded.dictionary)
        place = np.full(len(coded.dictionary), -1, np.int64)
        place[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        new = coded.dictionary.filter(pa.array(place < 0))
        place[place < 0] = len(self.known) + np.arange(len(new))
        size, ids = self._learn(new.to_pylist())
        self.known = pa.concat_arrays([self.known, new])
        self.size, self.ids = np.r_[self.size, size], np.r_[self.ids, ids]
        tail = self._whole(tails.dictionary.to_pylist(), self.tails)
        # a row of the table for each word, one for each distinct tail; a word without one has the empty tail
        row = np.full((len(words), 2), -1, np.int64)
        row[:, 0] = place[coded.indices.to_numpy()]
        row[at, 1] = len(self.known) + tails.indices.to_numpy()
        out = _gathered(np.r_[self.size, [len(x) // 4 for x in tail], 0].astype(np.int64),
                        np.r_[self.ids, np.frombuffer(b"".join(tail), np.uint32)], row.ravel())
        if len(self.known) > REMEMBERED:  # what was met just now stays
            met = np.unique(place)
            self.size, self.ids = _gathered(self.size, self.ids, met)
            self.known = self.known.take(pa.array(met))
        if len(self.tails) > REMEMBERED // 32:
            self.tails.clear()
        return out[0].reshape(-1, 2).sum(axis=1), out[1]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """For each text (null: empty) its ids."""
        texts = texts.cast(pa.string()).fill_null("")
        cut = pc.split_pattern(texts, " ")
        at = cut.offsets.to_numpy()
        at, flat = at - at[0], cut.flatten()
        coded = flat.dictionary_encode()
        word, distinct = coded.indices.to_numpy().copy(), coded.dictionary
        # a word that is empty or begins with white space: the cut before it is within a run of that
        odd = pc.match_substring_regex(distinct, r"^(\s|\pZ|\x{85}|[\x1c-\x1f]|$)")
        inner = np.ones(len(word), bool)
        inner[at[:-1]] = False
        wrong = (np.flatnonzero(np.add.reduceat(odd.to_numpy(zero_copy_only=False)[word] & inner, at[:-1]))
                 if len(texts) else [])
        # texts with such words are cut with care, into pieces that may hold spaces
        cuts = [_BETWEEN.split(t) for t in texts.take(pa.array(wrong, pa.int64())).to_pylist()]
        more = {w for first, *x in cuts for w in x}
        plain, spaced = [w for w in more if " " not in w], [w for w in more if " " in w]
        size, table = self._words(pa.concat_arrays([pc.if_else(odd, "x", distinct), pa.array(plain, pa.string())]))
        place = {w: len(distinct) + i for i, w in enumerate(plain)}
        place.update((w, len(size) + i) for i, w in enumerate(spaced))
        heads = len(size) + len(spaced)
        word[at[:-1]] = heads + np.arange(len(texts))
        whole = self._ids([" " + w for w in spaced])
        whole += self._whole(flat.take(pa.array(at[:-1])).to_pylist() + [x[0] for x in cuts], self.heads)
        size = np.r_[size, [len(x) // 4 for x in whole]].astype(np.int64)
        table = np.r_[table, np.frombuffer(b"".join(whole), np.uint32)]
        begin, out = np.cumsum(size) - size, []
        for a in range(0, len(texts), 256):
            part = word[at[a]:at[min(a + 256, len(texts))]]
            n, all_ids = _gathered(size, table, part, begin)
            end = np.cumsum(n)
            out += np.split(all_ids, end[at[a + 1:min(a + 256, len(texts))] - at[a] - 1])
        for k, i in enumerate(wrong):
            rows = [heads + len(texts) + k, *[place[w] for w in cuts[k][1:]]]
            out[i] = _gathered(size, table, np.array(rows), begin)[1]
        if len(self.heads) > REMEMBERED // 32:
            self.heads.clear()
        return out


def _gathered(size: np.ndarray, ids: np.ndarray, rows: np.ndarray, begin: np.ndarray | None = None):
    """The sizes and the ids of ``rows``, each of which has ``size`` ids in ``ids``, one after the other."""
    begin = np.cumsum(size) - size if begin is None else begin
    n = size[rows]
    end = np.cumsum(n)
    return n, ids[np.repeat(begin[rows] - (end - n), n) + np.arange(n.sum())]


@lru_cache(maxsize=1)
def pieces_of(path: str) -> Pieces:
    """One encoder and memory for all tasks that a Python worker runs."""
    return Pieces(path)


def tokenize(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
             end: int = END) -> DataFrame:
    """(``doc_id``, ``ids``: packed(), the end id included) of each document."""
    def run(batches):
        pieces = pieces_of(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts, AT_ONCE):
                ids = pieces.encode(texts.slice(a, b - a))
                data = [packed(x, end) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), pa.array(data, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, ids binary")


def counts(tokens: DataFrame) -> np.ndarray:
    """How often each id stands in all of ``ids``; at most the vocabulary's length reaches the driver."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            rows = batch.column(0)
            for a in range(0, len(rows), 256):
                c = np.bincount(np.concatenate([unpacked(x.as_buffer()) for x in rows[a:a + 256]]))
                if len(c) > len(total):
                    c[:len(total)] += total
                    total = c
                else:
                    total[:len(c)] += c
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    rows = (tokens.select("ids").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(max(rows["id"].to_pylist(), default=0) + 1, np.int64)
    out[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return out


def quantised(n: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies in proportion to ``n`` that add up to ``1 << scale``, at least 1 for each id seen."""
    total, seen = int(n.sum()), np.flatnonzero(n)
    if not total:
        n, total, seen = np.ones(1, np.int64), 1, np.array([0])
    if len(seen) > 1 << scale:
        raise ValueError("more distinct ids than the frequency table has places")
    f = np.where(n > 0, np.maximum(1, (n.astype(object) * (1 << scale) // total).astype(np.int64)), 0)
    over = int(f.sum()) - (1 << scale)
    order = np.argsort(-f, kind="stable")
    while over:
        # the largest frequencies bear the difference
        for i in order:
            if not over or f[i] <= 1 and over > 0:
                break
            d = min(over, max(1, int(f[i]) // 2), int(f[i]) - 1) if over > 0 else over
            f[i] -= d
            over -= d
    return f


class Coder:
    """rANS over 32-bit words with 64-bit states below 2 ** 63."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.freq = freq.astype(np.uint64)
        self.start = np.r_[0, np.cumsum(freq)[:-1]].astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray, lanes: int = LANES, steps: int = STEPS) -> bytes:
        """A block's bytes. The segments of a block are coded side by side."""
        n = len(ids)
        segments = max(1, -(-n // (lanes * steps)))
        grid = np.full(segments * lanes * steps, -1, np.int64)
        grid[:n] = ids
        grid = grid.reshape(segments, steps, lanes).transpose(1, 0, 2)  # steps, segments, lanes
        used = int((grid[:, 0, 0] >= 0).sum()) if segments == 1 else steps
        state = np.full((segments, lanes), LOW, np.uint64)
        words, marks = [], []
        thirty_two, top = np.uint64(32), np.uint64(63) - self.scale
        for step in range(used - 1, -1, -1):
            s = grid[step]
            live = s >= 0
            s = np.where(live, s, 0)
            f = np.where(live, self.freq[s], 1)
            spill = live & (state >= (f << top))
            words.append((state[spill] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            marks.append(np.flatnonzero(spill))
            state = np.where(spill, state >> thirty_two, state)
            q = state // f
            state = np.where(live, (q << self.scale) + (state - q * f) + self.start[s], state)
        # reading goes the other way: steps forward, lanes in order
        seg = np.concatenate([m // lanes for m in reversed(marks)]) if marks else np.zeros(0, np.int64)
        flat = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        order = np.argsort(seg, kind="stable")
        size = np.bincount(seg, minlength=segments)
        head = MAGIC + struct.pack("<5I", lanes, steps, n, zlib.crc32(ids.astype("<u4").tobytes()), segments)
        table = b"".join(struct.pack("<I", size[i]) + state[i].astype("<u8").tobytes() for i in range(segments))
        return head + table + flat[order].astype("<u4").tobytes()

    def decode(self, data: bytes) -> np.ndarray:
        """The ids of a block; raises ValueError if the checksum or a state is wrong."""
        if data[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        lanes, steps, n, crc, segments = struct.unpack_from("<5I", data, 4)
        entry = np.dtype([("words", "<u4"), ("state", "<u8", (lanes,))])
        table = np.frombuffer(data, entry, segments, 24)
        words = np.frombuffer(data, "<u4", -1, 24 + entry.itemsize * segments)
        if int(table["words"].astype(np.int64).sum()) != len(words):
            raise ValueError("the block's words don't match its checkpoints")
        at = np.r_[0, np.cumsum(table["words"].astype(np.int64))][:-1]
        state = table["state"].copy()
        out = np.zeros((min(steps, -(-n // lanes)) if segments == 1 else steps, segments, lanes), np.uint32)
        place = (np.arange(segments)[:, None] * (lanes * steps) + np.arange(lanes)).astype(np.int64)
        words = np.append(words, np.uint32(0)).astype(np.uint64)
        low_bits = np.uint64((1 << int(self.scale)) - 1)
        for step in range(len(out)):
            live = place + step * lanes < n
            slot = state & low_bits
            s = self.symbol[slot]
            f, c = self.freq[s], self.start[s]
            state = np.where(live, f * (state >> self.scale) + slot - c, state)
            need = live & (state < LOW)
            rank = np.cumsum(need, axis=1)
            from_ = np.minimum(at[:, None] + rank - 1, len(words) - 1)
            state = np.where(need, (state << np.uint64(32)) | words[np.where(need, from_, 0)], state)
            at = at + rank[:, -1]
            out[step] = s
        ids = out.transpose(1, 0, 2).reshape(-1)[:n].astype("<u4")
        if zlib.crc32(ids.tobytes()) != crc or (state != LOW).any():
            raise ValueError("the block's checksum doesn't match its ids")
        return ids


_BLOCK_ROWS = "part int, block int, docs array<struct<doc_id:bigint,at:bigint,n:bigint>>, n long, data binary"


def write_tokens(docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text",
                 end: int = END, block: int = BLOCK) -> str:
    """Write the ids of all documents, in ascending order of ids, below ``folder``.

    One pass over the texts writes ``folder/tokens``; the counts and then the
    blocks are made from it, and it is deleted. Ids are shuffled once, texts not
    at all. A block ends with the document that fills it."""
    spark = docs.sparkSession
    tokenize(docs, path, doc_id, text, end).write.option("compression", "zstd").parquet(f"{folder}/tokens")
    tokens = spark.read.parquet(f"{folder}/tokens")
    freq = quantised(counts(tokens))
    spark.createDataFrame(pa.table({"id": np.arange(len(freq)), "freq": freq})).coalesce(1).write.parquet(
        f"{folder}/table")

    def run(batches):
        from pyspark import TaskContext

        pieces_of.cache_clear()  # the worker may have made tokens before
        coder, part, number = Coder(freq), TaskContext.get().partitionId(), 0
        held, docs, n, at = [], [], 0, 0
        for batch in batches:
            for key, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = unpacked(x.as_buffer())
                docs.append({"doc_id": key, "at": at, "n": len(ids)})
                held.append(ids)
                at, n = at + len(ids), n + len(ids)
                if n >= block:
                    yield _block(part, number, docs, coder.encode(np.concatenate(held)), n)
                    held, docs, n, number = [], [], 0, number + 1
        if docs:
            yield _block(part, number, docs, coder.encode(np.concatenate(held)), n)

    (tokens.select("doc_id", "ids", F.xxhash64("ids").alias("tie"))
     .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
     .mapInArrow(run, _BLOCK_ROWS).write.option("compression", "uncompressed").parquet(f"{folder}/blocks"))
    delete_copy(spark, f"{folder}/tokens")
    return folder


def _block(part, number, docs, data, n):
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([docs], kind),
         pa.array([n], pa.int64()), pa.array([data], pa.binary())],
        names=["part", "block", "docs", "n", "data"])


def packed(ids: np.ndarray, end: int) -> bytes:
    """The low halves of the ids and ``end``, then their high halves (mostly zero, so they
    cost little on disk)."""
    out = np.empty((2, len(ids) + 1), "<u2")
    out[:, :-1] = ids.astype("<u4").view("<u2").reshape(-1, 2).T
    out[:, -1] = end & 0xFFFF, end >> 16
    return out.tobytes()


def unpacked(data) -> np.ndarray:
    x = np.frombuffer(data, "<u2").astype(np.uint32)
    half = len(x) // 2
    return x[:half] | x[half:] << np.uint32(16)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of each document from the files: ``start`` counts the ids of all
    documents before it, ``ids`` holds little-endian u32 numbers."""
    blocks = spark.read.schema(_BLOCK_ROWS).parquet(f"{folder}/blocks")
    freq_rows = spark.read.parquet(f"{folder}/table").toArrow().sort_by("id")
    freq = freq_rows["freq"].to_numpy()
    # one row for each part that was written
    sizes = blocks.groupBy("part").agg(F.sum("n").alias("n")).toArrow().sort_by("part")
    base = dict(zip(sizes["part"].to_pylist(), np.r_[0, np.cumsum(sizes["n"].to_numpy())].tolist()))

    def run(batches):
        coder = Coder(freq)
        for batch in batches:
            for part, docs, data in zip(*(batch.column(i) for i in range(3))):
                ids, docs = coder.decode(data.as_py()), docs.as_py()
                zero, first = base[part.as_py()], docs[0]["at"]
                cut = [ids[d["at"] - first:d["at"] - first + d["n"]].tobytes() for d in docs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d["doc_id"] for d in docs], pa.int64()),
                     pa.array([zero + d["at"] for d in docs], pa.int64()), pa.array(cut, pa.binary())],
                    names=["doc_id", "start", "ids"])

    return blocks.select("part", "docs", "data").mapInArrow(run, "doc_id long, start long, ids binary")


def new_folder(spark: SparkSession) -> str:
    """A name below the shared checkpoint folder that is not in use."""
    return f"{ensure_checkpoint_dir(spark)}/token-output-{uuid.uuid4().hex}"


def default_path() -> str:
    """The tokenizer of the contract; its place comes from the installed package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digest(tokens: DataFrame) -> DataFrame:
    """Contract digest of ``read_tokens``."""
    return tokens.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                         F.crc32("ids").alias("ids_crc32"))


def query(spark, sf_dir):
    """All documents, written to files in the shared checkpoint folder and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(read_tokens(spark, write_tokens(docs, new_folder(spark), default_path())))
