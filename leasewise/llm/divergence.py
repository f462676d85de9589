"""Source divergence audit: kept terms by iceberg prefix refinement, exact distances of sources.

A term is kept where enough documents of its language hold it.  Texts are read
level by level: at a level, terms up to its byte length are counted whole, and
of longer ones only the prefix, by distinct documents.  A prefix with too few
documents cannot begin a kept term, so the next level leaves out all that it
begins.  Prefixes that stay go to the tasks as bits of their hashes, in a
table of bounded size: a clash only lets a term through that its own count
then drops.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import cut
from .common import pieces

DOCUMENTS = 10  # documents of its language that a kept term stands in
TOP = 10  # terms listed for each source
FIRST_LEVEL = 6  # bytes of the first prefixes
GROWTH = 4  # each level multiplies them
BITS_AT_MOST = 27  # 2**27 bits are 16 MB
HELD = 300_000  # keys a task counts before it hands them on
CHUNK = 4_096  # terms of a language that one group compares; more where it has over a quarter as many sources
BLOCK = 256  # sources that one group compares with all others
CELLS = 1 << 21  # term and source cells held in memory at once
SCALE = 1_000_000_000

# Small letters stay, A to Z become small, bytes of other characters stay, all else parts the terms of [^\x00-\x40\x5B-\x60\x7B-\x7F]+.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_PAGE = 32_768  # bits of one bitmap of Spark's bitmap functions


# ---- prefix refinement

def _hash(lang: str | Column, prefix: bytes | Column):
    """XXH64 of the prefix, seeded with that of the language; the same number in Python and in Spark."""
    if isinstance(lang, Column):
        return F.xxhash64(lang, prefix)
    return xxhash.xxh64_intdigest(prefix, xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42))


def _bits(prefixes: DataFrame) -> tuple[np.ndarray, int]:
    """The hashes of (lang, key) rows as a bit table, and its width: 16 bits a row as far as the bound allows."""
    rows = prefixes.count()
    width = min(BITS_AT_MOST, max(15, (16 * rows - 1).bit_length()))
    place = F.shiftrightunsigned(_hash(F.col("lang"), F.col("key")), 64 - width)
    pages = prefixes.select(place.alias("_place")).groupBy(F.expr(f"_place div {_PAGE}").alias("page")).agg(
        F.bitmap_construct_agg(F.col("_place") % _PAGE).alias("bits"))
    table = np.zeros((1 << width) // 8, np.uint8)
    for r in pages.collect():  # 4,096 pages of 4 KB at most
        table[r["page"] * _PAGE // 8:(r["page"] + 1) * _PAGE // 8] = np.frombuffer(r["bits"], np.uint8)
    return table, width


class _Alive(dict):
    """Which prefixes of a language stay, as they are asked for."""

    def __init__(self, lang: str, table: np.ndarray, width: int):
        super().__init__()
        self.lang, self.table, self.width = lang, table, width

    def __missing__(self, prefix: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        place = _hash(self.lang, prefix) >> (64 - self.width)
        self[prefix] = stays = self.table[place >> 3] >> (place & 7) & 1
        return stays


class _Held:
    """Counts of one task: documents and occurrences of whole terms, documents of prefixes."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.terms: dict[tuple[str, str], dict[bytes, int]] = {}
        self.prefixes: dict[str, Counter] = {}
        self.size = 0

    def add(self, lang: str, source: str, terms: list[tuple[bytes, int]], prefixes: set[bytes]) -> None:
        of = self.terms.setdefault((lang, source), {})
        starts = self.prefixes.setdefault(lang, Counter())
        self.size -= len(of) + len(starts)
        for t, n in terms:
            of[t] = of.get(t, 0) + (n << 32 | 1)  # a task holds fewer than 2**32 documents at a time
        starts.update(prefixes)
        self.size += len(of) + len(starts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), of in self.terms.items():
            packed = list(of.values())
            yield _batch(lang, source, True, list(of), [p & 0xFFFFFFFF for p in packed], [p >> 32 for p in packed])
        for lang, starts in self.prefixes.items():
            yield _batch(lang, "", False, list(starts), list(starts.values()), [0] * len(starts))
        self.clear()


def _batch(lang: str, source: str, whole: bool, keys: list[bytes], docs: list[int], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "lang": pa.array([lang] * len(keys), pa.string()), "source": pa.array([source] * len(keys), pa.string()),
        "whole": pa.array([whole] * len(keys), pa.bool_()), "key": pa.array(keys, pa.binary()),
        "docs": pa.array(docs, pa.int64()), "n": pa.array(n, pa.int64())})


def _level(docs: DataFrame, before: int, level: int, alive: tuple[np.ndarray, int] | None) -> DataFrame:
    """(lang, source, whole, key, docs, n) of terms over `before` bytes: terms up to `level` bytes whole, else their prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = _Held(), {}
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                for text, lang, source in zip(*(piece.column(c).to_pylist() for c in ("text", "lang", "source"))):
                    found = Counter(text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()).items()
                    if alive is not None:
                        stays = known.get(lang)
                        if stays is None:
                            stays = known[lang] = _Alive(lang, *alive)
                        found = [(t, n) for t, n in found if len(t) > before and stays[t[:before]]]
                    held.add(lang, source, [f for f in found if len(f[0]) <= level], {t[:level] for t, _ in found if len(t) > level})
                    if held.size >= HELD:
                        yield from held.batches()
                        known.clear()
        yield from held.batches()

    counted = docs.mapInArrow(run, "lang string, source string, whole boolean, key binary, docs long, n long")
    return counted.groupBy("lang", "source", "whole", "key").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def kept_terms(docs: DataFrame, documents: int = DOCUMENTS, first_level: int = FIRST_LEVEL) -> DataFrame:
    """(lang, term, parts, n): terms in `documents` or more documents (rows) of their language.

    `docs` has text, lang and source without nulls.  `parts` are the (source,
    n) with n occurrences, one for each source that holds the term; `n` is
    their sum.  Each level is one pass over the texts; they end at the level
    whose prefixes all stand in too few documents.
    """
    before, level, alive, counted = 0, first_level, None, None
    while True:
        made = cut(_level(docs, before, level, alive))
        whole = made.filter("whole").drop("whole")
        counted = whole if counted is None else counted.unionByName(whole)
        prefixes = made.filter(f"not whole and docs >= {int(documents)}").select("lang", "key")
        if prefixes.isEmpty():
            break
        alive, before, level = _bits(prefixes), level, GROWTH * level
    return counted.groupBy("lang", "key").agg(
        F.collect_list(F.struct("source", "n")).alias("parts"), F.sum("n").alias("n"), F.sum("docs").alias("_docs")
    ).filter(F.col("_docs") >= documents).select("lang", F.col("key").cast("string").alias("term"), "parts", "n")


# ---- distances

def _share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total) in whole numbers, three digits at a time so that nothing overflows."""
    rest, share = count + 2, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        share, rest = share * 1000 + rest // total, rest % total
    return share + 1


def _compared(key: tuple, terms: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Distances of one block of sources to all others over one chunk of terms, and the block's leading terms."""
    lang, first, width = (groups.column(c)[0].as_py() for c in ("lang", "first", "width"))
    listed = groups.column("sources").combine_chunks().flatten()
    order = pc.sort_indices(listed.field("source"))
    names, totals = listed.field("source").take(order), listed.field("n").take(order).to_numpy(zero_copy_only=False)
    v, whole = groups.column("v")[0].as_py(), groups.column("total")[0].as_py()
    n_sources, block = len(names), np.arange(first, min(first + width, len(names)))
    sums = np.zeros((len(block), n_sources), np.int64)
    leading: list[list[tuple[int, bytes]]] = [[] for _ in block]
    step = max(1, CELLS // n_sources)
    for start in range(0, terms.num_rows, step):
        part = terms.slice(start, step).combine_chunks()
        parts, texts = part.column("parts").combine_chunks(), part.column("term").combine_chunks()
        counts = np.zeros((len(part), n_sources), np.int64)
        flat = parts.flatten()
        row = np.repeat(np.arange(len(part)), parts.value_lengths().to_numpy(zero_copy_only=False))
        counts[row, pc.index_in(flat.field("source"), value_set=names).to_numpy(zero_copy_only=False)] = flat.field("n").to_numpy(zero_copy_only=False)
        p = _share(counts, totals + 2 * v)
        q = _share(part.column("n").to_numpy(), whole + 2 * v)
        for i, g in enumerate(block):
            sums[i] += ((p[:, g:g + 1] - p) ** 2 // (p[:, g:g + 1] + p)).sum(axis=0)
            at = np.flatnonzero((counts[:, g] > 0) & (p[:, g] > q))
            value = (p[at, g] - q[at]) ** 2 // (p[at, g] + q[at])
            if len(at) > top:
                stay = value >= np.partition(value, len(at) - top)[len(at) - top]
                at, value = at[stay], value[stay]
            found = leading[i] + [(-f, texts[int(t)].as_py().encode("utf-8", "surrogatepass")) for f, t in zip(value.tolist(), at.tolist())]
            leading[i] = sorted(found)[:top]
    source, part_, item, value = [], [], [], []
    text = names.to_pylist()
    for i, g in enumerate(block.tolist()):
        for h in range(n_sources):
            if h != g:
                source.append(text[g]), part_.append("pair"), item.append(text[h]), value.append(int(sums[i, h]))
        for f, t in leading[i]:
            source.append(text[g]), part_.append("term"), item.append(t.decode("utf-8", "surrogatepass")), value.append(-f)
    return pa.table({"lang": pa.array([lang] * len(source), pa.string()), "source": pa.array(source, pa.string()), "part": pa.array(part_, pa.string()),
                     "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                      documents: int = DOCUMENTS, top: int = TOP, first_level: int = FIRST_LEVEL) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language are from each other and from it.

    Part `pair` has a row for each other source of the language, part `term`
    the `top` terms that the source has more of than its language.  Values are
    exact whole numbers.  Null text, language and source are ''.  Repeated
    rows are documents of their own; ties go to the smaller item (UTF-8 bytes).
    A source without terms, as with null or empty texts only, has its pairs;
    a language with one source has no pairs.  An empty table gives no rows.

    Chunks of a language's terms are compared with each other's sources in
    groups of CHUNK terms and BLOCK sources; the sums over chunks are added in
    Spark.  A group holds the sources of its language, which the result pairs,
    and gives fewer rows than a quarter of the cells it reads.
    """
    named = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    terms = cut(kept_terms(named, documents, first_level))
    groups = named.select("lang", "source").distinct()
    by_group = terms.select("lang", F.explode("parts").alias("p")).groupBy("lang", "p.source").agg(F.sum("p.n").alias("n"))
    by_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("total"))
    langs = groups.join(by_group, ["lang", "source"], "left").groupBy("lang").agg(
        F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n"))).alias("sources")).join(by_lang, "lang", "left").select(
        "lang", "sources", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total"))
    langs = cut(langs.withColumns({"chunks": F.expr(f"v div greatest({CHUNK}, 4 * size(sources)) + 1"), "blocks": F.expr(f"(size(sources) + {BLOCK - 1}) div {BLOCK}")}))
    spread = lambda rows: rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = spread(langs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))).select(
        "lang", "chunk", "block", (F.col("block") * BLOCK).alias("first"), F.lit(BLOCK).alias("width"), "sources", "v", "total")
    left = spread(terms.join(langs.select("lang", "chunks", "blocks"), "lang")).select(
        "lang", F.pmod(F.xxhash64("term"), "chunks").alias("chunk"), "block", "term", "parts", "n")

    def run(key: tuple, chunk: pa.Table, of: pa.Table) -> pa.Table:
        return _compared(key, chunk, of, top)

    keys = ("lang", "chunk", "block")
    made = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "lang string, source string, part string, item string, value long")
    summed = made.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    w = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(w)).filter(f"part = 'pair' or rank <= {int(top)}")


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
terms AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term),
lang_counts AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term),
lang_totals AS (SELECT lang, sum(n) AS n FROM lang_counts GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.n + 2 * v.v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
lang_shares AS (
  SELECT l.lang, l.term, 1 + (1000000000::hugeint * (l.n + 2)) // (t.n + 2 * v.v) AS q
  FROM lang_counts l JOIN lang_totals t USING (lang) JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
made AS (
  SELECT p.lang, p.source, 'pair' AS part, p.item, coalesce(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)), 0) AS value
  FROM pairs p LEFT JOIN shares a ON a.lang = p.lang AND a.source = p.source
  LEFT JOIN shares b ON b.lang = p.lang AND b.source = p.item AND b.term = a.term GROUP BY p.lang, p.source, p.item
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, ((s.p - l.q) * (s.p - l.q)) // (s.p + l.q)
  FROM shares s JOIN lang_shares l ON l.lang = s.lang AND l.term = s.term WHERE s.n > 0 AND s.p > l.q),
ranked AS (
  SELECT lang, source, part, item, value::bigint AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM made)
SELECT lang, source, part, item, value, rank::integer AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
