"""Operator 5, token-id output coded with a static range asymmetric numeral system (rANS).

Three passes, each a plain map over rows that a lost executor can redo:

1. ``token_blocks``: texts are range-partitioned by id and sorted, tokenised, and cut at document
   ends into blocks of about ``BLOCK`` ids. A block row carries its documents' ids and lengths.
2. ``frequency_table``: the tasks' counts of ids are added (at most one row per vocabulary entry) and
   scaled to a power of two; every id that occurs keeps a frequency of at least one. This one table is
   shared by all blocks.
3. ``write_coded``: every block is coded on its own with interleaved states (lanes). Checkpoints
   (all states and the word position every ``CHECK`` steps) allow decoding from the middle of a block;
   a checksum covers the payload. ``read_coded`` checks and decodes the blocks in any order.

File format: a folder with ``table`` (token, freq) and ``blocks``, both Parquet as a container, so
Spark's writers commit them and any store can hold them. A block's payload is little-endian:
magic, version, bits, lanes, ids, checkpoints, words; the start states (u64 per lane); per checkpoint
the step, the word position and the states; the words (u32). ``start`` counts all ids before the block.

Decoding state x: slot = x mod 2**bits; id = table[slot]; x = freq * (x >> bits) + slot - first[id];
if x < 2**31, x = x << 32 | next word. Step k of lane l holds id k * lanes + l.

Defined results: null text is empty (one end id); null ids come first, equal ids in an order
fixed by their texts; an empty table gives empty files; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import byte_groups, release_memory, ship_package, stage, text_or_empty

END_ID = 2
BLOCK = 1 << 18
LANES = 2048
CHECK = 64
TEXT_BYTES = 8 << 20
MAX_PARTITIONS = 10_000
PARTITION_BYTES = 12 << 20
#: ASCII signs behind a word. The apostrophe stays with the word: it may begin an ending of the tokenizer's own.
TRAILING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LONGEST_SIGNS = 16
MAGIC = b"rANS"
LOW = np.uint64(1 << 31)
HEADER = struct.Struct("<4sHHIQII")
BLOCK_SCHEMA = "part long, block long, local_start long, n_ids long, doc_ids array<long>, doc_lens array<long>, data binary, counts binary"


class ChunkEncoder:
    """Ids of texts whose tokenizer lower-cases and never joins across ASCII white space.

    Arrow cuts the texts at white space, finds the distinct chunks of a group of texts, cuts ASCII signs off their ends and looks the
    words and the signs up among the known ones; texts are then assembled from these by numpy. Only unknown words
    reach Python: those of lower-case letters in composed form need no normalising or splitting and go straight to the library's
    model (in its byte-level alphabet). Chunks that are neither go through the whole tokenizer, ``JOIN`` at a time as one text
    whose ids are told apart by offsets. ``limit`` bounds the known words: beyond it the less used half goes.
    """

    JOIN = 2000

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        self.library, self.limit = Tokenizer.from_file(path), limit
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.letters = _byte_letters()
        # known words; a length of -1: no word, its chunks are odd
        self.known = pa.array([""], pa.string())
        self.pool = np.zeros(0, np.uint32)
        self.starts, self.lens, self.uses = np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, np.int64)
        self.odd: dict[str, np.ndarray] = {}
        self.signs: dict[str, np.ndarray] = {}

    def find(self, strings: pa.Array) -> np.ndarray:
        """Places of distinct words among the known ones; unknown ones are learnt."""
        at = pc.index_in(strings, self.known)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        if len(new):
            at[new] = len(self.known) + np.arange(len(new))
            self.learn(strings.take(pa.array(new)))
        self.uses[at] += 1
        return at

    def learn(self, strings: pa.Array) -> None:
        tokenize = self.library.model.tokenize
        ascii_only = pc.string_is_ascii(strings)
        plain = pc.and_(ascii_only, pc.and_(pc.ascii_is_alpha(strings), pc.ascii_is_lower(strings))).to_numpy(zero_copy_only=False)
        flat = [t.id for word in strings.filter(pa.array(plain)).to_pylist() for t in tokenize(word)]
        lens, starts = np.full(len(plain), -1, np.int64), np.zeros(len(plain), np.int64)
        wide = np.flatnonzero(~ascii_only.to_numpy(zero_copy_only=False))
        fine, more = [], []
        for i, word in zip(wide.tolist(), strings.take(pa.array(wide)).to_pylist(), strict=True):
            if word.isalpha() and word == word.lower() and is_normalized("NFC", word):
                fine.append(i)
                more += [t.id for t in tokenize(word.encode("utf-8").decode("latin-1").translate(self.letters))]
        for at, some in ((np.flatnonzero(plain), flat), (np.array(fine, np.int64), more)):
            ids = np.array(some, np.uint32)
            lens[at] = np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0)
            starts[at] = len(self.pool) + np.cumsum(lens[at]) - lens[at]
            self.pool = np.concatenate([self.pool, ids])
        self.starts, self.lens = np.concatenate([self.starts, starts]), np.concatenate([self.lens, lens])
        self.uses = np.concatenate([self.uses, np.zeros(len(plain), np.int64)])
        self.known = pa.concat_arrays([self.known, strings])

    def odd_ids(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of chunks that only the whole tokenizer can cut."""
        if len(self.odd) > self.limit // 10:
            self.odd.clear()
        new = [c for c in dict.fromkeys(chunks) if c not in self.odd]
        for i in range(0, len(new), self.JOIN):
            part = new[i:i + self.JOIN]
            e = self.library.encode(" ".join(part), add_special_tokens=False)
            begin = np.cumsum([0] + [len(c) + 1 for c in part[:-1]])
            owner = np.searchsorted(begin, [o[0] for o in e.offsets], side="right") - 1
            stop = np.cumsum(np.bincount(owner.astype(np.int64), minlength=len(part)))
            self.odd.update(zip(part, np.split(np.array(e.ids, np.uint32), stop[:-1]), strict=True))
        return [self.odd[c] for c in chunks]

    def sign_ids(self, sign: str) -> np.ndarray:
        if sign not in self.signs:
            if len(self.signs) > self.limit // 10:
                self.signs.clear()
            self.signs[sign] = np.array(self.library.encode(sign, add_special_tokens=False).ids, np.uint32)
        return self.signs[sign]

    def forget(self) -> None:
        """Keep the more used half (and the empty word)."""
        self.uses[0] = np.iinfo(np.int64).max
        keep = np.sort(np.argsort(-self.uses, kind="stable")[:self.limit // 2])
        lens = np.maximum(self.lens[keep], 0)
        stop = np.cumsum(lens)
        self.pool = self.pool[np.repeat(self.starts[keep] - (stop - lens), lens) + np.arange(stop[-1])]
        self.lens, self.starts, self.uses = self.lens[keep], stop - lens, self.uses[keep] // 2
        self.known = self.known.take(pa.array(keep))

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct chunks, and their lengths."""
        stems = pc.ascii_rtrim(chunks, TRAILING)
        kinds = stems.dictionary_encode()
        word = self.find(kinds.dictionary)[kinds.indices.to_numpy()]
        tail = (pc.binary_length(chunks).to_numpy() - pc.binary_length(stems).to_numpy())
        odd = (self.lens[word] < 0) | (tail > LONGEST_SIGNS)
        word[odd] = 0
        sign, told = np.zeros(len(word), np.int64), [np.zeros(0, np.uint32)]
        for n in np.unique(tail[(tail > 0) & ~odd]).tolist():
            some = np.flatnonzero((tail == n) & ~odd)
            signs = pc.utf8_slice_codeunits(chunks.take(pa.array(some)), -n).dictionary_encode()
            sign[some] = len(told) + signs.indices.to_numpy()
            told += map(self.sign_ids, signs.dictionary.to_pylist())
        sign_lens = np.array([len(t) for t in told])
        n_word, n_sign = self.lens[word], sign_lens[sign]
        others = np.flatnonzero(odd)
        whole = self.odd_ids(chunks.take(pa.array(others, pa.int64())).to_pylist())
        lens = n_word + n_sign
        lens[others] = [len(o) for o in whole]
        end = np.cumsum(lens)
        pool = np.zeros(int(end[-1]) if len(end) else 0, np.uint32)
        for source, starts, n, begin in ((self.pool, self.starts[word], n_word, end - lens),
                                         (np.concatenate(told), (np.cumsum(sign_lens) - sign_lens)[sign], n_sign, end - n_sign)):
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pool[np.repeat(begin, n) + nth] = source[np.repeat(starts, n) + nth]
        for at, ids in zip((end - lens)[others].tolist(), whole, strict=True):
            pool[at:at + len(ids)] = ids
        return pool, lens

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the texts' lengths in ids."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if len(self.known) > self.limit:
            self.forget()
        # special tokens keep their case; everything else is lower-cased by the tokenizer anyway, but after composing: a capital
        # may compose with a mark of U+0300 to U+037F otherwise than its small letter
        as_is = pc.match_substring_regex(texts, "<\\||[\u0300-\u037f]")
        words = pc.ascii_split_whitespace(pc.if_else(as_is, texts, pc.ascii_lower(texts)))
        kinds = words.flatten().dictionary_encode()
        pool, lens = self.chunk_ids(kinds.dictionary)
        # one more chunk: the end of a text
        pool, lens = np.append(pool, np.uint32(END_ID)), np.append(lens, 1)
        starts = np.cumsum(lens) - lens
        stops = words.offsets.to_numpy()[1:] - words.offsets[0].as_py()
        at = np.insert(kinds.indices.to_numpy(), stops, len(lens) - 1)
        n = lens[at]
        stop = np.cumsum(n)
        ids = pool[np.repeat(starts[at] - (stop - n), n) + np.arange(stop[-1])]
        return ids, np.diff(stop[stops + np.arange(len(stops))], prepend=0)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on, in order."""
    fine = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in fine]
    return {b: chr(0x100 + i) for i, b in enumerate(others)}


_ENCODERS: dict[str, ChunkEncoder] = {}


def token_blocks(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK, max_partitions: int = MAX_PARTITIONS) -> DataFrame:
    """Blocks of token ids in ascending id order: rows of ``BLOCK_SCHEMA``, ids as u32.

    A partition has about ``PARTITION_BYTES`` of text, up to ``max_partitions`` partitions; beyond that they grow (the driver keeps one
    number per partition). Give more for more than 120 GB of text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(max_partitions, -(-size // PARTITION_BYTES)))
    ordered = (docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
               .select("doc_id", "text", F.spark_partition_id().cast("long").alias("part")))

    def run(batches):
        encoder = _ENCODERS.get(tokenizer)
        if encoder is None:
            encoder = _ENCODERS[tokenizer] = ChunkEncoder(tokenizer)
        held_ids, held_lens, data, count, local, number, part = [], [], [], 0, 0, 0, 0
        total = np.zeros(0, np.int64)

        def flush(counts=None):
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "block": pa.array([number], pa.int64()),
                "local_start": pa.array([local], pa.int64()), "n_ids": pa.array([count], pa.int64()),
                "doc_ids": pa.array([held_ids], pa.list_(pa.int64())), "doc_lens": pa.array([held_lens], pa.list_(pa.int64())),
                "data": pa.array([b"".join(data)], pa.binary()), "counts": pa.array([counts], pa.binary())})

        for b in batches:
            if not b.num_rows:
                continue
            names, part = b.column(0).to_pylist(), b.column(2)[0].as_py()
            for lo, hi in byte_groups(b.column(1), TEXT_BYTES):
                ids, lens = encoder.encode(b.column(1).slice(lo, hi - lo))
                ids, at = ids.astype("<u4"), 0
                total = _added(total, np.bincount(ids))
                for name, n in zip(names[lo:hi], lens.tolist(), strict=True):
                    held_ids.append(name)
                    held_lens.append(n)
                    data.append(ids[at:at + n].tobytes())
                    at, count = at + n, count + n
                    if count >= block:
                        yield flush()
                        local, number, count = local + count, number + 1, 0
                        held_ids, held_lens, data = [], [], []
            release_memory()
        if number or held_ids:
            yield flush(_packed_counts(total))

    return ordered.mapInArrow(run, BLOCK_SCHEMA)


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if len(a) < len(b):
        a, b = b, a
    a = a.copy()
    a[:len(b)] += b
    return a


def _packed_counts(total: np.ndarray) -> bytes:
    token = np.flatnonzero(total)
    return token.astype("<i8").tobytes() + total[token].astype("<i8").tobytes()


def frequency_table(blocks: DataFrame) -> tuple[int, list[tuple[int, int]]]:
    """Bits, and (id, frequency) in ascending id order, frequencies adding up to 2**bits.

    Every task of ``token_blocks`` left the counts of its ids with its last block, so the blocks are not read for this."""
    def unpack(batches):
        for b in batches:
            for counts in b.column(0):
                token, n = np.frombuffer(counts.as_py(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_pydict({"token": pa.array(token, pa.int64()), "n": pa.array(n, pa.int64())})

    told = blocks.where("counts is not null").select("counts")
    rows = told.mapInArrow(unpack, "token long, n long").groupBy("token").agg(F.sum("n")).collect()
    if not rows:
        return 16, []
    token, n = np.array(sorted(map(tuple, rows)), np.int64).T
    bits = max(16, min(28, int(np.ceil(np.log2(len(token)))) + 4))
    room = (1 << bits) - len(token)
    freq = 1 + np.floor(n / n.sum() * room).astype(np.int64)
    freq[np.argmax(freq)] += (1 << bits) - freq.sum()
    return bits, list(zip(token.tolist(), freq.tolist(), strict=True))


def _tables(freqs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    token, freq = np.array(freqs, np.int64).reshape(-1, 2).T
    return token, freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)


def encode_block(symbols: np.ndarray, bits: int, freq: np.ndarray, first: np.ndarray, lanes: int = LANES,
                 check: int = CHECK) -> bytes:
    """symbols: positions in the table. Codes backwards, so that decoding runs forwards."""
    n = len(symbols)
    lanes = max(1, min(lanes, 1 << max(0, (n // 64).bit_length() - 1)))
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    words, marks, emitted = [], [], 0
    shift, up, top = np.uint64(bits), np.uint64(32), freq << np.uint64(63 - bits)
    for k in range(steps - 1, -1, -1):
        s = symbols[k * lanes:(k + 1) * lanes]
        m = len(s)
        f, y = freq[s], x[:m]
        full = y >= top[s]
        if full.any():
            out = y[full]
            words.append(out.astype("<u4"))
            emitted += len(out)
            y = np.where(full, y >> up, y)
        q, r = np.divmod(y, f)
        x[:m] = (q << shift) + r + first[s]
        if k and k % check == 0:
            marks.append((k, emitted, x.copy()))
    words.reverse()
    out = [HEADER.pack(MAGIC, 1, bits, lanes, n, len(marks), emitted), x.astype("<u8").tobytes()]
    for k, so_far, state in reversed(marks):
        out += [struct.pack("<II", k, emitted - so_far), state.astype("<u8").tobytes()]
    return b"".join(out + [w.tobytes() for w in words])


def decode_block(data: bytes, slots: np.ndarray, freq: np.ndarray, first: np.ndarray, mark: int | None = None) -> np.ndarray:
    """The block's symbols, or from checkpoint ``mark`` on its tail."""
    magic, version, bits, lanes, n, n_marks, n_words = HEADER.unpack_from(data)
    if (magic, version) != (MAGIC, 1):
        raise ValueError("not a coded block")
    at, step, word = HEADER.size, 0, 0
    each = 8 + 8 * lanes
    words = np.frombuffer(data, "<u4", n_words, at + 8 * lanes + n_marks * each).astype(np.uint64)
    if mark is not None:
        at += 8 * lanes + mark * each + 8
        step, word = struct.unpack_from("<II", data, at - 8)
    x = np.frombuffer(data, "<u8", lanes, at).astype(np.uint64)
    out = np.empty(max(0, n - step * lanes), np.int64)
    shift, mask, up, done = np.uint64(bits), np.uint64((1 << bits) - 1), np.uint64(32), 0
    while done < len(out):
        m = min(lanes, len(out) - done)
        y = x[:m]
        slot = y & mask
        s = slots[slot.view(np.int64)]
        y = freq[s] * (y >> shift) + slot - first[s]
        low = np.flatnonzero(y < LOW)
        if len(low):
            y[low] = (y[low] << up) | words[word:word + len(low)]
            word += len(low)
        x[:m] = y
        out[done:done + m] = s
        done += m
    return out


def write_coded(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                max_partitions: int = MAX_PARTITIONS) -> None:
    """Tokenise ``docs`` and write the coded files to ``path``."""
    spark = docs.sparkSession
    ship_package(spark)
    blocks = stage(token_blocks(docs, tokenizer, id_col, text_col, max_partitions=max_partitions), "op5-ids")
    bits, freqs = frequency_table(blocks)
    spark.createDataFrame(freqs, "token long, freq long").coalesce(1).write.parquet(f"{path}/table")
    sizes = sorted(blocks.groupBy("part").agg(F.sum("n_ids")).collect())  # one row per partition, MAX_PARTITIONS at most
    offsets, total = {}, 0
    for part, n in sizes:
        offsets[part], total = total, total + n

    def run(batches):
        token, freq, first = _tables(freqs)
        place = np.zeros(int(token.max()) + 1 if len(token) else 1, np.int64)
        place[token] = np.arange(len(token))
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                data = encode_block(place[np.frombuffer(row["data"], "<u4")], bits, freq, first)
                yield pa.RecordBatch.from_pydict({
                    "start": pa.array([offsets[row["part"]] + row["local_start"]], pa.int64()),
                    "n_ids": pa.array([row["n_ids"]], pa.int64()),
                    "doc_ids": pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                    "doc_lens": pa.array([row["doc_lens"]], pa.list_(pa.int64())),
                    "data": pa.array([data], pa.binary()), "crc32": pa.array([zlib.crc32(data)], pa.int64())})

    blocks.where("n_ids > 0").drop("counts").mapInArrow(run, "start long, n_ids long, doc_ids array<long>, doc_lens array<long>, data binary, crc32 long"
                      ).write.parquet(f"{path}/blocks")


def read_coded(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (u32, little-endian), decoded block by block."""
    freqs = [tuple(r) for r in spark.read.schema("token long, freq long").parquet(f"{path}/table").orderBy("token").collect()]

    def run(batches):
        token, freq, first = _tables(freqs)
        slots = np.repeat(np.arange(len(token), dtype=np.int32), freq.astype(np.int64))
        for b in batches:
            for r in range(b.num_rows):
                data = b.column("data")[r].as_py()
                if zlib.crc32(data) != b.column("crc32")[r].as_py():
                    raise ValueError("a block's checksum differs")
                ids = token[decode_block(data, slots, freq, first)].astype("<u4")
                lens = np.array(b.column("doc_lens")[r].as_py(), np.int64)
                stop = np.cumsum(lens)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_ids")[r].values,
                    "start": pa.array(b.column("start")[r].as_py() + stop - lens, pa.int64()),
                    "n_tokens": pa.array(lens, pa.int64()),
                    "ids": pa.array([raw[4 * (e - n):4 * e] for e, n in zip(stop.tolist(), lens.tolist(), strict=True)], pa.binary())})

    blocks = spark.read.parquet(f"{path}/blocks")
    return blocks.select("start", "doc_ids", "doc_lens", "data", "crc32").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def code_and_read(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` in the coded format and return the documents read back from the files."""
    path = path or scratch_dir(docs.sparkSession, "op5-coded")
    write_coded(docs, tokenizer, path)
    return read_coded(docs.sparkSession, path).withColumn("ids_crc32", F.crc32("ids"))
