"""Vector code compression by active-entry Lloyd rounds.

Every component x becomes the integer floor(4096 x); a vector is cut into
``parts`` equal consecutive parts, and every part position has a codebook
of ``entries`` entries, fitted by Lloyd rounds over all vectors.

Each part keeps its entry and its exact squared distance from round to
round.  A part whose entry did not move compares only the entries that did
move against that distance -- the others lost to it before and have not
changed; a part whose entry moved rescans the whole codebook.  Ties go to
the lower index both times, so the result is that of complete scans.

Where the work runs: the vectors never leave their partition.  A round is
one narrow map that carries (parts, entries, distances) on local disk, with
the lineage kept (a lost executor's rows are computed again from the scan),
and one aggregation of at most ``entries`` x dimension sums per task; only
the codebooks, of that same fixed size, reach the driver.

Defined cases: null vectors and vectors with null, NaN or infinite
components are dropped.  The first ``entries`` kept rows by (vec_id, nulls
last, vector) start the codebooks; with fewer rows there are as many
entries.  The dimension is that of the first kept row, filled up with zeros
to a multiple of ``parts``; rows of another dimension cannot be cut alike
and keep null code and error.  Components so large that a squared distance
would leave 64 bits raise an error.  Repeated ids and rows each count, an
empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import stored, table

SCALE = 4096
_STATE = "vec_id long, label {}, ints array<int>, entry array<int>, distance array<long>"


def kept_vectors(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Rows whose vector and all its components are there and finite."""
    inf = "double('infinity')"
    return df.filter(f"{vec} is not null and forall({vec}, x -> x is not null and not isnan(x) and abs(double(x)) < {inf})")


def _integers(flat: np.ndarray, dim: int) -> np.ndarray:
    out = np.floor(flat.astype(np.float64) * SCALE)
    if out.size and np.abs(out).max() > math.isqrt((2 ** 63 - 1) // max(1, dim)) // 2:
        raise ValueError("a component is too large for 64-bit squared distances")
    return out.astype(np.int64)


def _squares(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    d = x - entry
    return (d * d).sum(-1)


def assign(x: np.ndarray, codebooks: np.ndarray, moved: np.ndarray, entry: np.ndarray | None,
           distance: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries of ``x`` (rows, parts, width) and their squared
    distances.  ``entry``/``distance`` are those of the last round (None:
    first round); ``moved`` (parts, entries) tells which entries changed
    since.  Also returns the number of distances computed."""
    n, parts, _ = x.shape
    k = codebooks.shape[1]
    done = 0
    if entry is None:
        entry, distance = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
        full = np.ones((n, parts), bool)
    else:
        entry, distance = entry.copy(), distance.copy()
        full = moved[np.arange(parts), entry]
    for p in range(parts):
        rows = np.flatnonzero(full[:, p])
        if len(rows):
            at = x[rows, p]
            d = np.stack([_squares(at, codebooks[p, e]) for e in range(k)], 1)
            entry[rows, p] = d.argmin(1)  # the first, so the lowest index, of equal distances
            distance[rows, p] = d.min(1)
            done += d.size
        rest = np.flatnonzero(~full[:, p])
        active = np.flatnonzero(moved[p])
        if len(rest) and len(active):
            at, best, least = x[rest, p], entry[rest, p], distance[rest, p]
            for e in active:
                d = _squares(at, codebooks[p, e])
                wins = (d < least) | ((d == least) & (e < best))
                best, least = np.where(wins, e, best), np.where(wins, d, least)
            entry[rest, p], distance[rest, p] = best, least
            done += len(rest) * len(active)
    return entry, distance, done


def _matrix(col: pa.Array, *shape: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), *shape).astype(np.int64)


def _lists(x: np.ndarray, kind: pa.DataType, use: np.ndarray) -> pa.Array:
    """A list column: row i of ``x`` where ``use`` counts up, else null."""
    offsets = np.concatenate([[0], np.cumsum(use) * x.shape[1]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.reshape(-1), kind), mask=pa.array(~use))


class Lloyd:
    """Codebooks fitted to ``df`` (vec_id, label, vec) and the codes of its
    rows under them."""

    def __init__(self, df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, vec: str = "embedding"):
        self.spark, self.parts, self.rounds = df.sparkSession, parts, rounds
        rows = kept_vectors(df, vec).select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                                            F.col(vec).cast("array<double>").alias("vec"))
        self.schema = _STATE.format(rows.schema["label"].dataType.simpleString())
        order = [F.col("vec_id").asc_nulls_last(), F.col("vec")]
        first = rows.orderBy(*order).limit(entries).select("vec").collect()
        self.length = len(first[0]["vec"]) if first else 0
        self.width = -(-self.length // parts)
        if any(len(r["vec"]) != self.length for r in first):
            first = rows.filter(F.size("vec") == self.length).orderBy(*order).limit(entries).select("vec").collect()
        first = [r["vec"] for r in first]
        self.entries = len(first)
        start = np.zeros((self.entries, parts * self.width), np.int64)
        start[:, :self.length] = _integers(np.array(first, float).reshape(self.entries, self.length), parts * self.width)
        #: (parts, entries, width)
        self.codebooks = start.reshape(self.entries, parts, self.width).transpose(1, 0, 2).copy()
        self.state = self._fit(rows)

    def _cut(self, rows: DataFrame) -> DataFrame:
        """Integer parts, no entry yet."""
        length, dim = self.length, self.parts * self.width

        def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                col = b.column(2)
                use = col.value_lengths().to_numpy(zero_copy_only=False) == length
                flat = col.filter(pa.array(use)).flatten().to_numpy(zero_copy_only=False)
                x = np.zeros((int(use.sum()), dim), np.int64)
                x[:, :length] = _integers(flat, dim).reshape(len(x), length)
                nothing = pa.nulls(b.num_rows, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(x, pa.int32(), use), nothing,
                                                  nothing.cast(pa.list_(pa.int64()))],
                                                 ["vec_id", "label", "ints", "entry", "distance"])

        return rows.mapInArrow(cut, self.schema)

    def _assigned(self, state: DataFrame, codebooks: np.ndarray, moved: np.ndarray) -> DataFrame:
        parts, width = self.parts, self.width

        def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                use = b.column(2).is_valid().to_numpy(zero_copy_only=False)
                some = b.filter(pa.array(use))
                x = _matrix(some.column(2), parts, width)
                known = some.num_rows and some.column(3).null_count == 0
                entry, distance, _ = assign(x, codebooks, moved, _matrix(some.column(3), parts) if known else None,
                                            _matrix(some.column(4), parts) if known else None)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], _lists(entry, pa.int32(), use), _lists(distance, pa.int64(), use)],
                                                 ["vec_id", "label", "ints", "entry", "distance"])

        return state.mapInArrow(step, self.schema)

    def _totals(self, state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Number and componentwise sum of the parts of every entry: one
        row per task and entry position is shuffled, whatever the rows."""
        parts, width, k = self.parts, self.width, self.entries

        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
            for b in batches:
                b = b.filter(b.column(0).is_valid())
                x = _matrix(b.column(0), parts, width)
                entry = _matrix(b.column(1), parts)
                for p in range(parts):
                    for e in range(k):
                        mine = entry[:, p] == e
                        count[p, e] += int(mine.sum())
                        total[p, e] += x[mine, p].sum(0)
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64()),
                                              pa.array(total[p, e].tolist(), pa.list_(pa.int64()))], ["p", "e", "n", "total"])

        some = state.select("ints", "entry").mapInArrow(add, "p int, e int, n long, total array<long>")
        sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        count, total = np.zeros((parts, k), object), np.zeros((parts, k, width), object)
        for r in some.groupBy("p", "e").agg(F.sum("n").alias("n"), *sums).collect():  # parts x entries rows
            count[r["p"], r["e"]] = int(r["n"])
            total[r["p"], r["e"]] = [int(r[f"s{i}"]) for i in range(width)]
        return count, total

    def _fit(self, rows: DataFrame) -> DataFrame:
        state = self._cut(rows)
        moved = np.ones((self.parts, self.entries), bool)
        held = None
        for _ in range(self.rounds):
            state = self._assigned(state, self.codebooks, moved).persist(StorageLevel.DISK_ONLY)
            count, total = self._totals(state)
            if held is not None:
                held.unpersist()
            held = state
            new = self.codebooks.copy()
            for p, e in zip(*np.nonzero(count)):
                new[p, e] = [s // count[p, e] for s in total[p, e]]  # towards minus infinity
            moved = (new != self.codebooks).any(-1)
            self.codebooks = new
        self.held = held
        return self._assigned(state, self.codebooks, moved)

    def codes(self) -> DataFrame:
        """``vec_id, label, code, error`` of every kept row, stored."""
        code = F.array_join(F.transform("entry", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
        out = stored(self.state.select("vec_id", "label", F.when(F.col("entry").isNotNull(), code).alias("code"),
                                       F.when(F.col("entry").isNotNull(), F.aggregate("distance", F.lit(0).cast("long"), lambda a, d: a + d))
                                       .alias("error")), "codes")
        if self.held is not None:
            self.held.unpersist()
        return out

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry, position."""
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings; errors also summed over equal labels."""
    fitted = Lloyd(table(spark, sf_dir, "embeddings"))
    codes = fitted.codes()
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    return (codes.alias("c").join(by_label.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
            .select("c.vec_id", "c.code", "c.error", "l.label_error", F.lit(fitted.digest()).alias("codebooks_sha256")))


def oracle_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The contract with complete scans in every round, for DuckDB."""
    ctes = [
        "kept AS (SELECT vec_id, label, embedding, len(embedding) // %d AS w FROM embeddings WHERE embedding IS NOT NULL"
        " AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)" % parts,
        "pos AS (SELECT vec_id, label, w, embedding, unnest(range(len(embedding))) AS j FROM kept)",
        "x AS MATERIALIZED (SELECT vec_id, label, j // w AS p, j % w AS i, CAST(floor(4096 * CAST(embedding[j + 1] AS DOUBLE)) AS BIGINT) AS v FROM pos)",
        f"firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries})",
        "c0 AS MATERIALIZED (SELECT e, p, i, v FROM x JOIN firsts USING (vec_id))",
    ]
    for r in range(rounds + 1):
        ctes.append(f"d{r} AS (SELECT x.vec_id, x.p, c.e, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{r} c ON x.p = c.p AND x.i = c.i "
                    "GROUP BY x.vec_id, x.p, c.e)")
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, e, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS n "
                    f"FROM d{r}) WHERE n = 1)")
        if r < rounds:
            ctes.append(f"m{r} AS (SELECT a.e, a.p, x.i, CAST(floor(sum(x.v) / count(*)) AS BIGINT) AS v FROM x JOIN a{r} a "
                        "ON x.vec_id = a.vec_id AND x.p = a.p GROUP BY a.e, a.p, x.i)")
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT c.e, c.p, c.i, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m "
                        "ON c.e = m.e AND c.p = m.p AND c.i = m.i)")
    return ("WITH " + ",\n".join(ctes) + f""",
codes AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM c{rounds})
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM kept k JOIN codes c ON k.vec_id = c.vec_id CROSS JOIN book b""")


ORACLE_SQL = oracle_sql()
