"""Token ids in binary shards with a minimal perfect hash index.

Shard file ``shard-NNNNN.ids``: the 8 bytes ``LLTOKEN1``, the id size (2 or 4
bytes) and zero as 32-bit integers, all ids little-endian, and at the end the
numbers of documents and of ids as 64-bit integers.  Documents are dealt to
shards by range of their id and text hash and lie in ascending order, so shards
read in order hold the whole corpus in order, and one id may fill several.  Ids take 2 bytes where the vocabulary
allows.

Index file ``index-NNNNN.mph``: each bucket of keys has a minimal perfect hash
in levels.  A level is a bit array with a bit for every key that alone takes
its place; keys that collide go on to the next level.  A key's slot is the
number of set bits before its own, so slots are 0 .. n - 1; a rank directory
holds the set bits before each word.  Per slot follow the key's 64-bit
fingerprint, shard, first id and number of ids: a look-up reads a word a level,
a rank and four numbers, and a key that was never written fails its
fingerprint.

A key is (document id, ordinal among rows with that id).  Files are written
under a temporary name and renamed; a task that runs again after a lost
executor writes the same file.

Defined cases: null text has only the end id; a null document id sorts first
and is a key; rows that share an id get ordinals by hash of their text; an
empty table has no shards and an empty index.  Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from losslens.llm.byte_bpe import Numbering, Runs
from losslens.llm.common import arrow_rows, checkpoint, new_folder as shared_folder, text_blocks

MAGIC = b"LLTOKEN1"
END_ID = 1
SHARD_BYTES = 1 << 24
BUCKET_KEYS = 1 << 16
GAMMA = 2.0
FEW = 64  # look-ups of under this share of an index file's keys read only their own places
RUN = 1 << 16  # ordinals of one id that a row is spread to
ROWS = 4000  # texts in an Arrow batch
CACHE = 500_000  # parts that a task remembers
BLOCK = 1 << 24  # bytes of text encoded at once: the more, the fewer chunks are cut up again
BATCH = 8192  # parts sent to the library at once: its results are large
LINE = 64  # words in one text
#: fixed value: ASCII marks that end a token before them, all but the apostrophe
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def new_folder(spark: SparkSession) -> str:
    """A new folder on the storage that driver and executors share."""
    return shared_folder(spark, "tokens")


def _open(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    if folder.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    if "://" not in folder:
        return arrow_fs.LocalFileSystem(), folder
    return arrow_fs.FileSystem.from_uri(folder)


class _Output:
    """A file that appears under its name only when it is complete."""

    def __init__(self, folder: str, name: str):
        self.fs, path = _open(folder)
        self.fs.create_dir(path, recursive=True)
        self.path, self.part = f"{path}/{name}", f"{path}/.{name}-{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.part)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.part, self.path)


class WordEncoder:
    """Ids of texts by a ``tokenizers`` file that lowers letters, drops white
    space and keeps letters, digits and other marks in separate tokens, whose
    last one in a word ends in ``</w>``.

    No token spans a blank, a line feed, or the end of a run that normalizes to
    letters and digits before ASCII marks (other than an apostrophe).  Texts are cut
    there, and the library encodes each distinct part once per task; words of
    letters go to it by many in one text and are told apart by their ends.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.wide = max(vocabulary.values()) >= 1 << 16
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self):
        self.parts, self.runs = Numbering(), Runs()
        self.runs.extend(np.array([END_ID]), np.array([1]))  # row 0; part n is row n + 1

    def _learn(self, parts: list[str]) -> None:
        """Appends the ids of new parts."""
        words = [i for i, p in enumerate(parts) if p.isalpha()]
        others = [i for i, p in enumerate(parts) if not p.isalpha()]
        flat, sizes, order = [], [], []
        for k in range(0, len(words), BATCH):
            group = words[k:k + BATCH]
            lines = [group[j:j + LINE] for j in range(0, len(group), LINE)]
            for line, e in zip(lines, self._encode([" ".join([parts[i] for i in line]) for line in lines])):
                ids = np.asarray(e, np.int64)
                last = np.flatnonzero(self.ends[ids])
                if len(last) == len(line):
                    flat.append(ids)
                    sizes.append(np.diff(last, prepend=-1))
                    order += line
                else:
                    others += line
        for k in range(0, len(others), BATCH):
            group = others[k:k + BATCH]
            found = self._encode([parts[i] for i in group])
            flat += [np.asarray(ids, np.int64) for ids in found]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            order += group
        if not order:
            return
        found = Runs()
        found.extend(np.concatenate(flat), np.concatenate(sizes))
        place = np.empty(len(parts), np.int64)
        place[order] = np.arange(len(parts))
        self.runs.extend(*found.gather(place))

    def _letters_only(self, head: str) -> bool:
        """Whether normalizing leaves letters and digits only: a capital whose
        small form ends in a combining mark joins the marks after it."""
        return self.tokenizer.normalizer.normalize_str(head).isalnum()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ids per text), each with the end id."""
        if len(self.parts) > CACHE:
            self._forget()
        chunks, rows, count = Numbering(), [], []
        for t in texts:
            cut = t.replace("\n", " ").split(" ")
            row = np.fromiter(map(chunks.__getitem__, cut), np.int64, len(cut))
            rows.append(np.append(row + 1, 0))
            count.append(len(cut) + 1)
        number, of_chunk, sizes = self.parts, [0], [1]
        for c in chunks:
            head = c.rstrip(MARKS)
            if head.isalnum() and (head.isascii() or len(head) == len(c) or self._letters_only(head)):
                of_chunk.append(number[head.lower() if head.isascii() else head] + 1)
                if len(head) < len(c):
                    of_chunk.append(number[c[len(head):]] + 1)
                    sizes.append(2)
                else:
                    sizes.append(1)
            else:
                of_chunk.append(number[c] + 1)
                sizes.append(1)
        self._learn(number.take())
        parts = Runs()
        parts.extend(np.asarray(of_chunk), np.asarray(sizes))
        by_chunk = Runs()
        flat, size = self.runs.gather(parts.flat)
        by_chunk.extend(flat, np.add.reduceat(size, parts.start[:-1]))
        flat, size = by_chunk.gather(np.concatenate(rows))
        total = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
        return flat, np.diff(total)


@lru_cache(2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _write_shard(folder: str, tokenizer: str):
    """Sorted rows of one shard: writes its file, returns a row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, docs, ids, last, ordinal = TaskContext.get().partitionId(), None, 0, 0, None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            enc = word_encoder(tokenizer)
            kind = "<u4" if enc.wide else "<u2"
            if out is None:
                out = _Output(folder, f"shard-{shard:05d}.ids")
                out.write(MAGIC + np.array([4 if enc.wide else 2, 0], "<u4").tobytes())
            sizes = []
            for block in text_blocks(batch.column("t"), BLOCK):
                flat, size = enc.encode(block)
                out.write(flat.astype(kind).tobytes())
                sizes.append(size)
            size = np.concatenate(sizes)
            ordinals = []
            for key in batch.column("doc_id").to_pylist():
                ordinal = ordinal + 1 if docs and key == last else 0
                last, docs = key, docs + 1
                ordinals.append(ordinal)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ordinals, pa.int64()), pa.array(np.full(len(size), shard)),
                 pa.array(ids + np.cumsum(size) - size), pa.array(size)],
                ["doc_id", "ordinal", "shard", "first", "n_tokens"])
            ids += int(size.sum())
        if out is not None:
            out.write(np.array([docs, ids], "<u8").tobytes())
            out.close()
    return run


def _hashes() -> list:
    """Slot hash and fingerprint of the key columns."""
    return [F.xxhash64("doc_id", "ordinal").alias("h"), F.xxhash64(F.lit("print"), "ordinal", "doc_id").alias("print")]


def _spread(h: np.ndarray, level: int) -> np.ndarray:
    x = h.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_mph(h: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (as 64-bit words) of a minimal perfect hash of different
    64-bit keys."""
    levels = []
    while len(h):
        bits = -(-max(64, int(GAMMA * len(h))) // 64) * 64
        place = (_spread(h, len(levels)) % np.uint64(bits)).astype(np.int64)
        taken = np.bincount(place, minlength=bits)
        levels.append(np.packbits(taken == 1, bitorder="little").view("<u8"))
        h = h[taken[place] != 1]
    return levels


def rank_directory(levels: list[np.ndarray]) -> list[np.ndarray]:
    """Set bits before each word, over all levels."""
    ones = np.bitwise_count(np.concatenate([np.zeros(0, np.uint64), *levels])).astype(np.int64)
    before = (np.cumsum(ones) - ones).astype("<u4")
    return np.split(before, np.cumsum([len(x) for x in levels])[:-1]) if levels else []


def mph_slots(levels: list[np.ndarray], h: np.ndarray, ranks: list[np.ndarray] | None = None) -> np.ndarray:
    """Slot of each key; -1 for a key that no level holds."""
    slots, todo = np.full(len(h), -1, np.int64), np.arange(len(h))
    for level, (words, before) in enumerate(zip(levels, rank_directory(levels) if ranks is None else ranks)):
        place = (_spread(h[todo], level) % np.uint64(64 * len(words))).astype(np.int64)
        word, bit = words[place >> 6], (place & 63).astype(np.uint64)
        hit = (word >> bit) & np.uint64(1) == 1
        below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        slots[todo[hit]] = (before[place >> 6].astype(np.int64) + below)[hit]
        todo = todo[~hit]
    return slots


class Index:
    """An index file.  ``slots`` reads all of it for many keys; ``slot`` and
    ``entry`` read a word and a rank a level and four numbers, whatever the
    size of the file."""

    def __init__(self, file):
        self.file = file
        self.n, count = np.frombuffer(self._read(8, 16), "<u8").tolist()
        self.sizes = np.frombuffer(self._read(24, 8 * count), "<u8").astype(np.int64)
        self.words = 24 + 8 * count
        self.ranks = self.words + 8 * int(self.sizes.sum())
        self.columns = self.ranks + 4 * int(self.sizes.sum())

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def slot(self, h: int) -> int:
        """Slot of one key; -1 if no level holds it."""
        key, done = np.array([h], np.int64), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = int(_spread(key, level)[0] % np.uint64(64 * size))
            word = int.from_bytes(self._read(self.words + 8 * (done + (place >> 6)), 8), "little")
            if word >> (place & 63) & 1:
                before = int.from_bytes(self._read(self.ranks + 4 * (done + (place >> 6)), 4), "little")
                return before + (word & ((1 << (place & 63)) - 1)).bit_count()
            done += size
        return -1

    def entry(self, slot: int) -> list[int]:
        """Fingerprint, shard, first id and number of ids of a slot."""
        return [int(np.frombuffer(self._read(self.columns + 8 * (k * self.n + slot), 8), "<i8")[0]) for k in range(4)]

    def entries(self, h: np.ndarray) -> np.ndarray:
        """A column with those four numbers for each key; -1 for a key that no
        level holds."""
        if len(h) < self.n // FEW:
            slots = [self.slot(int(x)) for x in h]
            return np.array([self.entry(s) if s >= 0 else [-1] * 4 for s in slots], np.int64).reshape(-1, 4).T
        raw = self._read(self.words, self.columns - self.words + 32 * self.n)
        cuts, total = np.cumsum(self.sizes)[:-1], int(self.sizes.sum())
        levels = np.split(np.frombuffer(raw, "<u8", total), cuts)
        ranks = np.split(np.frombuffer(raw, "<u4", total, 8 * total), cuts)
        values = np.frombuffer(raw, "<i8", 4 * self.n, 12 * total).reshape(4, self.n)
        slots = mph_slots(levels, h, ranks) if total else np.full(len(h), -1)
        return np.where(slots >= 0, values[:, np.maximum(slots, 0)], -1)


def _by_bucket(batches: Iterator[pa.RecordBatch]):
    """(bucket, table) of rows sorted by bucket."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        ids = held.column("bucket").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield int(ids[a]), held.slice(a, b - a)
        held = held.slice(cuts[-1])
    if held is not None:
        yield held.column("bucket")[0].as_py(), held


def _write_index(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys in _by_bucket(batches):
            h = keys.column("h").to_numpy()
            levels = build_mph(h)
            order = np.argsort(mph_slots(levels, h))
            out = _Output(folder, f"index-{bucket:05d}.mph")
            out.write(MAGIC + np.array([len(h), len(levels), *map(len, levels)], "<u8").tobytes())
            out.write(b"".join(x.tobytes() for x in levels))
            out.write(b"".join(x.tobytes() for x in rank_directory(levels)))
            for c in ("print", "shard", "first", "n_tokens"):
                out.write(keys.column(c).to_numpy()[order].astype("<i8").tobytes())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([len(h)], pa.int64())],
                                             ["bucket", "n"])
    return run


def _look_up(folder: str):
    """Adds shard, first and n_tokens to keys sorted by bucket; a key that is
    not in the index raises."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        for bucket, keys in _by_bucket(batches):
            with files.open_input_file(f"{path}/index-{bucket:05d}.mph") as f:
                prints, shard, first, tokens = Index(f).entries(keys.column("h").to_numpy())
            if (shard < 0).any() or (prints != keys.column("print").to_numpy()).any():
                raise KeyError(f"a key is not in index bucket {bucket}")
            for part in pa.table([keys.column("doc_id"), keys.column("ordinal"), shard, first, tokens],
                                 ["doc_id", "ordinal", "shard", "first", "n_tokens"]).combine_chunks().to_batches():
                yield part
    return run


def _read_shards(folder: str, digest: bool):
    """Adds to rows sorted by shard and first id the ids' bytes (little-endian
    unsigned 32-bit), or only their unsigned CRC-32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _open(folder)
        name, f, width = None, None, 0
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                batch, raw = whole.slice(k, ROWS), []
                for shard, first, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "n_tokens"))):
                    if shard != name:
                        if f is not None:
                            f.close()
                        name, f = shard, files.open_input_file(f"{path}/shard-{shard:05d}.ids")
                        head = f.read(16)
                        if head[:8] != MAGIC:
                            raise ValueError(f"shard {shard} is not a token file")
                        width = int(np.frombuffer(head, "<u4", 1, 8)[0])
                    f.seek(16 + width * first)
                    ids = np.frombuffer(f.read(width * n), f"<u{width}").astype("<u4").tobytes()
                    raw.append(zlib.crc32(ids) if digest else ids)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.int64() if digest else pa.binary())],
                                                 [*batch.schema.names, "ids"])
        if f is not None:
            f.close()
    return run


def write_token_files(documents: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Shards, index and the table of shard starts, below the folder."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES), min(size >> 20, 2 * spark.sparkContext.defaultParallelism))
    written = (docs.repartitionByRange(int(shards), "doc_id", F.xxhash64("t"))  # an id's rows may fill several shards
               .sortWithinPartitions("doc_id", F.xxhash64("t"))
               .mapInArrow(_write_shard(folder, tokenizer),
                           f"doc_id {id_type}, ordinal long, shard long, first long, n_tokens long"))
    with arrow_rows(spark, ROWS):
        written.write.parquet(f"{folder}/entries")
    entries = _ordinals_over_shards(spark.read.parquet(f"{folder}/entries")).select("*", *_hashes())
    # one row per shard, so a plain ordered window over them
    (entries.groupBy("shard").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs"))
     .selectExpr("shard", "sum(n) OVER (ORDER BY shard) - n AS base", "n", "docs")
     .write.parquet(f"{folder}/shards"))
    buckets = _buckets(spark, folder)
    (entries.withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 17), F.lit(buckets)))
     .repartition(buckets, "bucket").sortWithinPartitions("bucket")
     .mapInArrow(_write_index(folder), "bucket long, n long").write.parquet(f"{folder}/buckets"))


def _ordinals_over_shards(entries: DataFrame) -> DataFrame:
    """Ordinals counted through all shards of an id.  Only the first and the
    last id of a shard can lie in others too."""
    row = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    ends = entries.groupBy("shard").agg(F.min(row).alias("a"), F.max(row).alias("b"))
    ids = ends.select(F.explode(F.array("a", "b")).alias("i")).select(F.col("i.doc_id").alias("id")).distinct()
    counts = (entries.join(ids, entries["doc_id"].eqNullSafe(ids["id"])).groupBy("id", "shard")
              .agg(F.count("*").alias("n")))
    before = Window.partitionBy("id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    later = checkpoint(counts.select("id", F.col("shard").alias("in"), F.sum("n").over(before).alias("before")).where("before > 0"))
    if later.isEmpty():
        return entries
    return (entries.join(later, entries["doc_id"].eqNullSafe(later["id"]) & (entries["shard"] == later["in"]), "left")
            .withColumn("ordinal", F.col("ordinal") + F.coalesce("before", F.lit(0))).select(*entries.columns))


def _buckets(spark: SparkSession, folder: str) -> int:
    docs = spark.read.parquet(f"{folder}/shards").agg(F.sum("docs")).first()[0] or 0
    return max(1, -(-docs // BUCKET_KEYS))


def locate(keys: DataFrame, folder: str) -> DataFrame:
    """(doc_id, ordinal, shard, first, n_tokens) of keys, from the index."""
    spark, id_type = keys.sparkSession, keys.schema["doc_id"].dataType.simpleString()
    buckets = _buckets(spark, folder)
    return (keys.select("doc_id", "ordinal", *_hashes())
            .withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 17), F.lit(buckets)))
            .repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_look_up(folder), f"doc_id {id_type}, ordinal long, shard long, first long, n_tokens long"))


def read_tokens(keys: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """Keys with start (ids before it in the corpus), n_tokens and ids
    (binary), read from the files; with digest, ids_crc32 instead of ids."""
    spark, id_type = keys.sparkSession, keys.schema["doc_id"].dataType.simpleString()
    shards = spark.read.parquet(f"{folder}/shards")
    read = (locate(keys, folder).repartition(max(1, shards.count()), "shard").sortWithinPartitions("shard", "first")
            .mapInArrow(_read_shards(folder, digest), f"doc_id {id_type}, ordinal long, shard long, first long, "
                                                      f"n_tokens long, ids {'long' if digest else 'binary'}"))
    return (read.join(shards.select("shard", "base"), "shard")
            .selectExpr("doc_id", "ordinal", "base + first AS start", "n_tokens",
                        f"ids AS {'ids_crc32' if digest else 'ids'}"))


def keys_of(documents: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ordinal) of every row, counted before they are spread; an id of
    many rows is spread in runs of ``RUN``."""
    runs = (documents.groupBy(F.col(id_col).alias("doc_id")).agg(F.count("*").alias("n"))
            .selectExpr("doc_id", "n", f"explode(sequence(0L, (n - 1) div {RUN})) AS run"))
    long = runs.where(f"n > {RUN}").repartition("doc_id", "run").union(runs.where(f"n <= {RUN}"))
    return long.selectExpr("doc_id", f"explode(sequence(run * {RUN}, least(n, (run + 1) * {RUN}) - 1)) AS ordinal")

