"""Token ids in raw binary shards, found by document key through a minimal perfect hash.

Layout of a store (a folder every executor reaches):

``shard-00000.ids``   token ids, little endian, two bytes each (four for large vocabularies),
                      documents one after the other in ascending key order
``shard-00000.off``   little-endian uint64 positions: document r of the shard is ids[off[r]:off[r+1]]
``index-000000.mph``  one bucket of the hash: level bit arrays with ranks, then one entry per
                      key: fingerprint, shard, row in the shard, rows with this key

A key is hashed to a bucket, then through the bucket's levels until its bit is set; the rank of
that bit is the entry.  Number of steps and bytes read do not depend on the size of the store.
The stored fingerprint turns away keys that were never put in (wrongly accepted: 2**-32).

Texts are encoded with a ``tokenizers`` file.  Pieces between the splitting points of its
byte-level pre-tokenizer are encoded once, by the library's model, and remembered, which gives the
same ids as encoding whole texts; tokenizers of another make, and texts with an added token in them,
are encoded whole.

Defined cases: null or empty text is the end id alone; rows repeated with one key are kept as
so many documents next to each other, the index entry holds their number; null keys come first
and are in the shards but not in the index; an empty table gives empty shards and no bucket.

Texts are read whole, however long; only the named columns are read, whatever others are called;
documents without a key are the first rows of the store and are read back by position.
"""

from __future__ import annotations

import json
import zlib
from codecs import charmap_decode
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.spans import span_hashes
from crestline.llm.common import (
    materialize, read_table, ship_code, shared_dir, shuffle_partitions, small_batches,
)

END_ID = 0
KEYS_PER_BUCKET = 50_000
ROWS_PER_READ = 2_048
REMEMBERED = 400_000
HASHED_AT_ONCE = 1 << 18
ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("row", "<u8"), ("rows", "<u4")])
LETTER, NUMBER, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
# The character that stands for each byte in a byte-level vocabulary; 255, which is in no UTF-8, parts pieces.
_BYTE_CHARS = "".join(_HIDDEN.get(b, chr(b)) for b in range(255)) + "\n"


# ---------------------------------------------------------------- encoding


def _some_at_a_time(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring pieces, to keep the working memory small."""
    a = 0
    while a < len(edges) - 1:
        b = max(int(np.searchsorted(edges, edges[a] + HASHED_AT_ONCE, "right")) - 1, a + 1)
        yield a, b
        a = b


def _piece_hashes(code: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = []
    for a, b in _some_at_a_time(edges):
        own = edges[a : b + 1] - edges[a]
        out.append(span_hashes(code[edges[a] : edges[b]], own[:-1], own[1:]))
    return np.concatenate(out)


def _same_pieces(code: np.ndarray, edges: np.ndarray, like: np.ndarray) -> bool:
    """Whether every piece has the characters of the piece that stands for it."""
    size = np.diff(edges)
    if (size[like] != size).any():
        return False
    for a, b in _some_at_a_time(edges):
        shift = np.repeat(edges[:-1][like[a:b]] - edges[a:b], size[a:b])
        if (code[np.arange(edges[a], edges[b]) + shift] != code[edges[a] : edges[b]]).any():
            return False
    return True


class Encoder:
    """Token ids of texts, equal to the library's, with pieces remembered between texts."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.added = [t["content"] for t in made.get("added_tokens", [])]
        before = made.get("pre_tokenizer") or {}
        self.by_piece = (
            made["model"]["type"] == "BPE" and not made["model"].get("dropout") and made.get("normalizer") is None
            and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            and made.get("truncation") is None and made.get("padding") is None
        )
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.known: dict[str, bytes] = {}

    def _bytes(self, ids: Sequence[int]) -> bytes:
        return np.asarray(ids, f"<u{self.width}").tobytes()

    def whole(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _pieces_alone(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that the pre-tokenizer does not split, by the model itself: what the library
        keeps of a text beside its ids takes several times longer than the ids of a word."""
        tokenize, ids, ends = self.tokenizer.model.tokenize, [], [0]
        shown, _ = charmap_decode(b"\xff".join([p.encode() for p in pieces]), "strict", _BYTE_CHARS)
        for piece in shown.split("\n"):
            ids += [t.id for t in tokenize(piece)]
            ends.append(len(ids))
        raw = self._bytes(ids)
        at = [e * self.width for e in ends]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _learn_kinds(self, codes: np.ndarray) -> None:
        """Ask the library which class of its splitting pattern each new character is in."""
        for code in np.unique(codes).tolist():
            c = chr(code)
            joined = [len(self.split(x + c)) == 1 for x in ("a", "1", "!")]
            self.kinds[code] = joined.index(True) if any(joined) else SPACE

    def _pieces(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """All texts as one, its characters, where pieces begin, first piece of each text."""
        all_text = "".join(texts)
        code = np.frombuffer(all_text.encode("utf-32-le"), "<u4")
        kind = self.kinds[code]
        if (kind == UNKNOWN).any():
            self._learn_kinds(code[kind == UNKNOWN])
            kind = self.kinds[code]
        ends = np.cumsum([len(t) for t in texts])
        first = np.zeros(len(code) + 1, bool)
        first[0] = True
        first[ends] = True
        start = first[:-1].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # The last white space before other characters: a blank joins them, the rest stand alone.
        after = np.flatnonzero(start[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:-1]) + 1
        start[after - 1] = True
        start[after[code[after - 1] == 32]] = False
        for k in np.flatnonzero((code == 39) & start).tolist():  # 's 't 're 've 'm 'll 'd
            stop = int(ends[np.searchsorted(ends, k, "right")])
            tail = all_text[k + 1 : min(k + 3, stop)]
            n = 2 if tail in ("re", "ve", "ll") else 1 if tail[:1] in ("s", "t", "m", "d") and tail else 0
            if n:
                start[k + 1] = False
                if n == 2:
                    start[k + 2] = False
                if k + 1 + n < len(start):
                    start[k + 1 + n] = True
        at = np.flatnonzero(start)
        return all_text, code, np.append(at, len(code)), np.searchsorted(at, np.concatenate([[0], ends]))

    def _by_piece(self, all_text: str, code: np.ndarray, edges: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Ids of each text, looking every distinct piece up once."""
        hashes = _piece_hashes(code, edges)
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not _same_pieces(code, edges, one[which]):  # two pieces share a hash: look all up
            one = which = np.arange(len(hashes))
        pieces = [all_text[a:b] for a, b in zip(edges[one].tolist(), edges[one + 1].tolist())]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        distinct = np.empty(len(pieces), object)
        distinct[:] = list(map(self.known.get, pieces))
        missing = np.flatnonzero(distinct == None).tolist()  # noqa: E711
        if missing:
            new = [pieces[i] for i in missing]
            distinct[missing] = made = self._pieces_alone(new)
            self.known.update(zip(new, made))
        found = distinct[which].tolist()
        return [b"".join(found[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self.whole(texts)
        odd = {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        plain = ["" if i in odd else t for i, t in enumerate(texts)]
        if not any(plain):
            out = [b""] * len(texts)
        else:
            out = self._by_piece(*self._pieces(plain))
        for i in odd:
            out[i] = self.whole([texts[i]])[0]
        return out


# ---------------------------------------------------------------- minimal perfect hash


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit integers for each seed, so distinct keys part at some level."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(keys, 0) % np.uint64(buckets)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Levels of bit arrays: a key belongs to the first level where no other remaining key
    shares its bit, and its number is the rank of that bit among all levels."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        ones = [np.bitwise_count(b).astype(np.int64) for b in bits]
        self.ranks, total = [], 0
        for o in ones:
            self.ranks.append(total + np.cumsum(o) - o)
            total += int(o.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, left = [], np.asarray(keys).astype(np.int64).view(np.uint64)
        while len(left):
            words = max(1, -(-len(left) * 2 // 64))
            at = (_mix(left, len(bits) + 2) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(at, minlength=words * 64) == 1
            bits.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(bits)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, 0 .. size - 1; some number or -1 for keys that were not put in."""
        keys = np.asarray(keys).astype(np.int64).view(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            at = _mix(keys[todo], level + 2) % np.uint64(len(bits) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = ranks[word[hit]] + np.bitwise_count(below[hit])
            todo = todo[~hit]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.bits), *map(len, self.bits)], "<u8").tobytes()
        return head + b"".join(b.tobytes() for b in self.bits)

    @classmethod
    def load(cls, data: memoryview) -> tuple[PerfectHash, int]:
        levels = int(np.frombuffer(data, "<u8", 1)[0])
        sizes = np.frombuffer(data, "<u8", levels, 8).tolist()
        at, bits = 8 * (levels + 1), []
        for n in sizes:
            bits.append(np.frombuffer(data, "<u8", n, at))
            at += 8 * n
        return cls(bits), at


# ---------------------------------------------------------------- files


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if ":/" in folder else (pafs.LocalFileSystem(), folder)


def _put(folder: str, name: str, parts: Iterator[bytes] | list[bytes]) -> None:
    """Write under a name of this attempt's own, then rename: no reader sees half a file."""
    where, path = _place(folder)
    task = TaskContext.get()
    own = f"{path}/.{name}-{task.taskAttemptId() if task else 0}"
    with where.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    where.move(own, f"{path}/{name}")


def _get(folder: str, name: str, start: int = 0, stop: int | None = None) -> bytes:
    where, path = _place(folder)
    with where.open_input_file(f"{path}/{name}") as file:
        file.seek(start)
        return file.read() if stop is None else file.read(stop - start)


@dataclass(frozen=True)
class Store:
    """Where the files are, and what is needed to use them: one number pair per shard."""

    folder: str
    width: int
    buckets: int
    tokens: tuple[int, ...]
    rows: tuple[int, ...]
    nulls: int = 0  # documents without a key, which are the first rows

    def find(self, keys: np.ndarray, bucket: int) -> np.ndarray:
        """Index entries of keys of one bucket; ``rows`` is 0 where there is none."""
        data = memoryview(_get(self.folder, f"index-{bucket:06d}.mph"))
        hashed, at = PerfectHash.load(data)
        entries = np.frombuffer(data, ENTRY, hashed.size, at)
        number = hashed.numbers(keys)
        out = entries[np.maximum(number, 0)].copy()
        out["rows"][(number < 0) | (out["print"] != fingerprint(keys.astype(np.int64).view(np.uint64)))] = 0
        return out

    def get(self, key: int) -> list[np.ndarray]:
        """Token ids of every document with a key."""
        keys = np.array([key], np.int64)
        if not self.buckets:
            return []
        entry = self.find(keys, int(bucket_of(keys.view(np.uint64), self.buckets)[0]))[0]
        row_base = np.cumsum([0, *self.rows])
        found = []
        for g in range(int(row_base[entry["shard"]] + entry["row"]), int(row_base[entry["shard"]] + entry["row"] + entry["rows"])):
            shard = int(np.searchsorted(row_base, g, "right")) - 1
            found += self.read(shard, g - int(row_base[shard]), g - int(row_base[shard]) + 1)[1]
        return found

    def read(self, shard: int, first: int, last: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Positions and token ids of rows first .. last - 1 of a shard."""
        off = np.frombuffer(_get(self.folder, f"shard-{shard:05d}.off", 8 * first, 8 * (last + 1)), "<u8").astype(np.int64)
        raw = _get(self.folder, f"shard-{shard:05d}.ids", int(off[0]) * self.width, int(off[-1]) * self.width)
        ids = np.frombuffer(raw, f"<u{self.width}")
        return off, [ids[a:b] for a, b in zip((off[:-1] - off[0]).tolist(), (off[1:] - off[0]).tolist())]


# ---------------------------------------------------------------- jobs


def by_volume(batches: Iterator[pa.RecordBatch], chars: int = 2 << 20) -> Iterator[tuple[list, list]]:
    """Keys and texts of batches, put together until there are so many characters."""
    keys, texts, volume = [], [], 0
    for batch in batches:
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys.append(k)
            texts.append(t)
            volume += len(t or "")
            if volume >= chars:
                yield keys, texts
                keys, texts, volume = [], [], 0
    if keys:
        yield keys, texts


def _width(spark: SparkSession, tokenizer: str) -> int:
    """Bytes of an id, found in a task: the driver would keep the tokenizer's memory."""

    def measure(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([Encoder.of(tokenizer).width] * b.num_rows, pa.int32())], names=["width"])

    return spark.range(0, 1, 1, 1).mapInArrow(measure, "width int").first().width


def write_store(
    docs: DataFrame, tokenizer: str, *, folder: str | None = None, key: str = "doc_id",
    text: str = "text", end_id: int = END_ID, shards: int | None = None,
) -> Store:
    """Encode all documents into shards in key order, and index their keys."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_dir(spark, "token-store")
    spark.createDataFrame([(0,)], "x int").write.parquet(f"{folder}/.made")  # makes the folder
    shards = shards or shuffle_partitions(spark)
    width = _width(spark, tokenizer)

    def write(batches):
        encoder = Encoder.of(tokenizer)
        shard, off, made = TaskContext.get().partitionId(), [0], []
        end = np.array([end_id], f"<u{width}").tobytes()

        def payload():
            for keys, texts in by_volume(batches):
                rows = [r + end for r in encoder.encode([t or "" for t in texts])]
                counts = [len(r) // width for r in rows]
                made.append((keys, len(off) - 1, counts))
                off.extend((off[-1] + np.cumsum(counts)).tolist())
                yield b"".join(rows)

        _put(folder, f"shard-{shard:05d}.ids", payload())
        _put(folder, f"shard-{shard:05d}.off", [np.array(off, "<u8").tobytes()])
        for keys, first, counts in made:
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(np.full(n, shard), pa.int32()),
                 pa.array(np.arange(first, first + n), pa.int64()), pa.array(counts, pa.int64())],
                names=["key", "shard", "row", "tokens"],
            )

    # Equal keys may be many: text hash and input position part them between shards.
    tie = [F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    keyed = keyed.withColumn("tie", F.struct(*tie))
    ordered = keyed.repartitionByRange(shards, "key", "tie").sortWithinPartitions("key", "tie")
    rows = materialize(
        ordered.select("key", "text").mapInArrow(write, "key long, shard int, row long, tokens long"),
        "token-rows",
    )
    sums = {r[0]: (r[1], r[2]) for r in rows.groupBy("shard").agg(F.sum("tokens"), F.count(F.lit(1))).collect()}
    last = max(sums, default=-1) + 1
    tokens, counts = zip(*[sums.get(s, (0, 0)) for s in range(last)]) if last else ((), ())

    keys = rows.where("key is not null").groupBy("key").agg(
        F.min(F.struct("shard", "row")).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    keys = materialize(keys.select("key", "first.shard", "first.row", "rows"), "token-keys")
    buckets = -(-keys.count() // KEYS_PER_BUCKET)
    _index(keys, folder, buckets)
    nulls = rows.where("key is null").count()
    return Store(folder, width, buckets, tuple(tokens), tuple(counts), nulls)


def _bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    """The bucket of each key, by the same arithmetic as ``bucket_of``."""

    def put(batches):
        for b in batches:
            k = b.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield b.append_column("bucket", pa.array(bucket_of(k, buckets)))

    return keys.mapInArrow(put, ", ".join(f"`{n}` {t}" for n, t in keys.dtypes) + ", bucket long")


def _index(keys: DataFrame, folder: str, buckets: int) -> None:
    if not buckets:
        return

    def build(table: pa.Table) -> pa.Table:
        key = table["key"].to_numpy().astype(np.int64)
        hashed = PerfectHash.build(key)
        entries = np.zeros(len(key), ENTRY)
        at = hashed.numbers(key)
        entries["print"][at] = fingerprint(key.view(np.uint64))
        for c in ("shard", "row", "rows"):
            entries[c][at] = table[c].to_numpy()
        bucket = table["bucket"][0].as_py()
        _put(folder, f"index-{bucket:06d}.mph", [hashed.dump(), entries.tobytes()])
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "keys": pa.array([len(key)], pa.int64())})

    _bucketed(keys, buckets).groupBy("bucket").applyInArrow(build, "bucket long, keys long").write.format("noop").mode("overwrite").save()


def read_store(store: Store, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents of the given keys, read from the files: key, start, n_tokens, ids_crc32.

    One row per stored document; keys that are not in the store give none.  A null key, if there is
    one, stands for all documents without a key: no index has them, but they are the first rows.
    """
    spark = keys.sparkSession
    ship_code(spark)
    wanted = keys.select(F.col(key).cast("long").alias("key")).where("key is not null").distinct()
    row_base = np.cumsum([0, *store.rows])
    token_base = np.cumsum([0, *store.tokens])

    def find(table: pa.Table) -> pa.Table:
        key = table["key"].to_numpy().astype(np.int64)
        entry = store.find(key, table["bucket"][0].as_py())
        first = row_base[entry["shard"].astype(np.int64)] + entry["row"].astype(np.int64)
        return pa.table({"key": key, "first": first, "rows": entry["rows"].astype(np.int64)})

    def read(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        at, key = table["at"].to_numpy(), table["key"]
        shard = np.searchsorted(row_base, at, "right") - 1
        out = {"key": key, "start": np.zeros(len(at), np.int64), "n_tokens": np.zeros(len(at), np.int64), "ids_crc32": np.zeros(len(at), np.int64)}
        # Runs of neighbouring rows are read at once.
        cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(shard) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
            s = int(shard[a])
            off, ids = store.read(s, int(at[a] - row_base[s]), int(at[b - 1] - row_base[s]) + 1)
            out["start"][a:b] = token_base[s] + off[:-1]
            out["n_tokens"][a:b] = np.diff(off)
            out["ids_crc32"][a:b] = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        return pa.table(out)

    schema = "key long, start long, n_tokens long, ids_crc32 long"
    spread = spark.createDataFrame([], "key long, at long")
    if store.buckets:
        found = _bucketed(wanted, store.buckets).groupBy("bucket").applyInArrow(find, "key long, first long, rows long")
        each = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("rows") - 1))
        spread = found.where("rows > 0").select("key", each.alias("at"))
    if store.nulls and keys.where(F.col(key).isNull()).limit(1).count():
        spread = spread.unionByName(spark.range(store.nulls).select(F.lit(None).cast("long").alias("key"), F.col("id").alias("at")))
    spread = spread.withColumn("block", F.floor(F.col("at") / ROWS_PER_READ))
    return spread.groupBy("block").applyInArrow(read, schema)


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    store = write_store(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return read_store(store, docs).withColumnRenamed("key", "doc_id")
