"""Document fingerprints from prefix polynomial hashes.

The array of prefix hashes of a text answers whether any two spans are equal
in constant time, and binary search over it finds how far two texts agree from
any two places on.  A fingerprint keeps the hash of the whole text and those of
prefixes and suffixes at regular lengths, so two fingerprints tell, by the same
search, how much of their texts' beginnings and ends agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_340_157_138, 915_478_221)  # any numbers between the largest code point and the primes
RUNGS = 32  # a fingerprint has this many prefixes at least (of a text with as many characters) and fewer than twice as many


class _Powers:
    """Powers of the bases and their inverses, as far as a text has needed them."""

    def __init__(self) -> None:
        self.up = [np.ones(1, np.int64) for _ in PRIMES]
        self.down = [np.ones(1, np.int64) for _ in PRIMES]

    def upto(self, n: int) -> None:
        while len(self.up[0]) <= n:
            for table, bases in ((self.up, BASES), (self.down, [pow(b, -1, p) for b, p in zip(BASES, PRIMES)])):
                for k, p in enumerate(PRIMES):
                    table[k] = np.r_[table[k], table[k] * pow(bases[k], len(table[k]), p) % p]


_POWERS = _Powers()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class Prefixes:
    """Prefix hashes of a text: entry i of an array is the sum of code[j] * base**j over j < i.

    Sums of terms below 2**31 stay below 2**63 for any text that fits memory.
    """

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        _POWERS.upto(self.n)
        self.sums = [np.r_[0, np.cumsum((codes + 1) * up[:self.n] % p)] % p for up, p in zip(_POWERS.up, PRIMES)]

    def spliced(self, keep: int, added: np.ndarray) -> Prefixes:
        """Prefixes of the first `keep` code points followed by `added`; those of the kept ones are reused."""
        made = object.__new__(Prefixes)
        made.n = keep + len(added)
        _POWERS.upto(made.n)
        made.sums = [np.r_[own[:keep + 1], (own[keep] + np.cumsum((added + 1) * up[keep:made.n] % p)) % p]
                     for own, up, p in zip(self.sums, _POWERS.up, PRIMES)]
        return made

    def span(self, start: np.ndarray | int, end: np.ndarray | int, k: int) -> np.ndarray:
        """Hash of code points start to end by prime k, the same wherever the span stands."""
        return (self.sums[k][end] - self.sums[k][start]) % PRIMES[k] * _POWERS.down[k][start] % PRIMES[k]

    def same(self, start: int, other: Prefixes, at: int, length: int) -> bool:
        return all(self.span(start, start + length, k) == other.span(at, at + length, k) for k in range(len(PRIMES)))

    def extension(self, start: int, other: Prefixes, at: int) -> int:
        """How many code points agree from `start` here and `at` there, by binary search."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.same(start, other, at, middle) else (low, middle - 1)
        return low

    def extension_back(self, end: int, other: Prefixes, at: int) -> int:
        """How many code points agree before `end` here and `at` there."""
        low, high = 0, min(end, at)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.same(end - middle, other, at - middle, middle) else (low, middle - 1)
        return low


@dataclass
class Fingerprint:
    """Length, hash of the whole, and hashes of the prefixes and suffixes of step, 2 * step and so on characters."""
    n: int
    whole: int
    starts: np.ndarray
    ends: np.ndarray

    @property
    def step(self) -> int:
        return max(1, (1 << self.n.bit_length() - 1) // RUNGS) if self.n else 1

    @classmethod
    def of(cls, text: Prefixes) -> Fingerprint:
        made = cls(text.n, int(text.sums[0][-1]) << 31 | int(text.sums[1][-1]), None, None)
        at = np.arange(made.step, text.n + 1, made.step)
        made.starts, made.ends = text.span(0, at, 0), text.span(text.n - at, text.n, 0)
        return made

    def __str__(self) -> str:
        rungs = np.r_[self.starts, self.ends].astype(">u4").tobytes().hex()
        return f"{self.n:x}-{self.whole:016x}-{rungs}"

    @classmethod
    def read(cls, value: str) -> Fingerprint:
        n, whole, rungs = value.split("-")
        rungs = np.frombuffer(bytes.fromhex(rungs), ">u4").astype(np.int64)
        return cls(int(n, 16), int(whole, 16), rungs[:len(rungs) // 2], rungs[len(rungs) // 2:])


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the common beginning of two arrays of prefix hashes, by binary search: a longer prefix agrees only where a shorter one does."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[middle - 1] == b[middle - 1] else (low, middle - 1)
    return low


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Share of the longer text that both begin or end with, to within a step for each; 1 for equal texts only.

    Steps are powers of two, so the coarser of two ladders is part of the finer.
    """
    if (a.n, a.whole) == (b.n, b.whole):
        return 1.0
    if not a.n or not b.n:
        return 0.0
    step = max(a.step, b.step)
    begin, end = (_agree(x[step // a.step - 1::step // a.step], y[step // b.step - 1::step // b.step])
                  for x, y in ((a.starts, b.starts), (a.ends, b.ends)))
    longer = max(a.n, b.n)
    return min((begin + end) * step, min(a.n, b.n), longer - 1) / longer


def _edited(text: str, codes: np.ndarray, own: Prefixes, following: str) -> tuple[str, Prefixes]:
    cut_ = len(text) // 4
    added = following[:cut_]
    return text[:len(text) - cut_] + added, own.spliced(len(text) - cut_, code_points(added))


SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _ranges(docs: DataFrame, keep: str, parts: int) -> list[int]:
    """The smallest id of each of `parts` ranges of ids of about equal rows (at most; a range may be empty)."""
    ids = docs.select(docs[keep].alias("id")).filter("id is not null").repartitionByRange(parts, "id")
    return sorted({r["least"] for r in ids.groupBy(F.spark_partition_id()).agg(F.min("id").alias("least")).collect()})


def edit_fingerprints(docs: DataFrame, keep: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, whose last quarter gives way to the beginning of the next text.

    Returns `keep`, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next.  The next document is the one of the next larger
    id (an integer); after the last comes the first.  Null texts are empty; an
    empty text is its own edited form.  Rows of one id follow each other in an
    order of their contents, null ids come last.  A table of one row is its own
    next one; an empty table gives no rows.

    The texts are shuffled once, packed, by ranges of ids; a range's first row
    goes to the range before it as well, so each task sees the texts of its
    rows one by one and the one after them.  The bounds of the ranges, one
    number for each of `parts` (spark.sql.shuffle.partitions by default), go
    through the driver as those of Spark's own range partitioning do.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads = np.array(_ranges(docs, keep, parts), np.int64)
    last = max(len(heads) - 1, 0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield _dealt(batch.slice(start, 256), heads, last)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a part in order; each is given out once the one after it is known."""
        part, before = None, None
        for batch in batches:
            out: list[tuple] = []
            for here, guest, id_, size, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "id", "size", "packed"))):
                if here != part:
                    part, before = here, None
                elif before is not None and before[4]:
                    continue  # the row after the part's last one is there
                value = pa.decompress(packed, size, "zstd", asbytes=True).decode("utf-8", "surrogatepass") if size else ""
                codes = code_points(value)
                own = Prefixes(codes)
                mark = Fingerprint.of(own)
                if before is not None:
                    out.append(_row(before, value, mark))
                before = (id_, value, own, mark, guest, codes)
            if out:
                yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for (n, t), c in zip(columns, zip(*out))})

    kind = docs.select(docs[keep]).schema[0].dataType
    columns = [(keep, pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
               ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    named = docs.select(docs[keep].cast("long").alias("id"), docs[text].alias("text"))
    dealt = named.mapInArrow(deal, "part int, guest boolean, id long, size long, packed binary").repartitionById(last + 1, "part")
    dealt = dealt.sortWithinPartitions("part", "guest", F.col("id").asc_nulls_last(), "size", "packed")
    made = dealt.mapInArrow(walk, f"`{keep}` long, {SCHEMA}")
    return made.withColumn(keep, F.col(keep).cast(kind))


def _dealt(batch: pa.RecordBatch, heads: np.ndarray, last: int) -> pa.RecordBatch:
    """Rows with the number of their range, packed; the rows of a first id a second time, as guests of the range before."""
    ids, texts = batch.column("id"), batch.column("text").to_pylist()
    none = ids.is_null().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy(zero_copy_only=False)
    part = np.where(none, last, np.maximum(np.searchsorted(heads, number, "right") - 1, 0))
    if len(heads):
        first = ~none & (heads[part] == number)
    else:
        first = none  # no ids at all: any row may be the first
    guests = np.flatnonzero(first)
    rows = np.r_[np.arange(len(number)), guests]
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    packed = [pa.compress(r, "zstd", asbytes=True) if r else b"" for r in raw]
    return pa.RecordBatch.from_pydict({
        "part": pa.array(np.r_[part, (part[guests] - 1) % (last + 1)].astype(np.int32)), "guest": pa.array(np.r_[np.zeros(len(number), bool), np.ones(len(guests), bool)]),
        "id": ids.take(pa.array(rows)), "size": pa.array([len(raw[i]) for i in rows], pa.int64()), "packed": pa.array([packed[i] for i in rows], pa.binary())})


def _row(before: tuple, following: str, next_mark: Fingerprint) -> tuple:
    id_, text, own, mark, _, codes = before
    edited, edited_own = _edited(text, codes, own, following)
    edited_mark = Fingerprint.of(edited_own)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return id_, own.n, digest, str(mark), str(edited_mark), likeness(mark, edited_mark), likeness(mark, next_mark)
