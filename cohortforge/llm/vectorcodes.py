"""Vector code compression: product quantisation in whole numbers, with exact nearest entries.

Each component becomes floor(1024 * x), a vector four equal parts, and each part the index of the nearest of at most 256
entries of its position's codebook.  Codebooks start as the parts of the vectors of least ids and are moved to the means
(floors of them) of the parts they hold, a given number of times.

*Screening.*  Squared distances less the part's own square, c * c - 2 x * c, come from one float32 matrix product for a
batch and a part.  A product of m terms is off by at most g |x| |c|, where g = k u / (1 - k u), u = 2**-24 and k counts the
roundings of a term (its own inputs', m additions, the product); rounding c * c and the difference adds less than is granted
here by counting eight more.  So the true values lie within an interval of known width around the screened ones, and only
entries whose interval overlaps that of the best can be nearest.  Where that leaves one entry, it is; all entries of other
rows are evaluated again in int64, and ties go to the lower index.  No result depends on how a product was added up.

*Spark.*  Vectors stay where they are: each round reads them, sends the codebooks (256 entries of the vectors' length, 8 bytes
a component) to all tasks, and gets one row of sums for each entry and task, which Spark adds up.  Nothing else passes the
driver.  Sums of a label are joined back by broadcast up to ``MOST_LABELS`` labels, beyond that by a join in which a label's
rows are dealt to ``SALTS`` parts.

Vectors that are null or hold a null or a component that isn't finite are dropped.  Shorter vectors count as padded with
zeros to the longest length, rounded up to a multiple of four.  Components must stay under 2**18 in size, so that all sums
fit in 64 bits; a larger one raises ValueError.  Null ids come last and start no codebook; of equal ids the vector that is
less (component by component) comes first.  Fewer than 256 vectors make smaller codebooks, none an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.shared import fresh, stored, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 1 << 18
BATCH_ROWS = 4096
MOST_LABELS, SALTS = 1 << 20, 32


# --- nearest entries -----------------------------------------------------------------------------


def nearest(x: np.ndarray, entries: np.ndarray, *, counts: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``entries`` for each row of ``x`` (both int64), and its exact squared distance.

    ``counts`` gets how many rows were decided by screening alone, and how many distances were computed in int64.
    """
    n, m = x.shape
    small, small_c = x.astype(np.float32), entries.astype(np.float32)
    squares = (entries * entries).sum(axis=1)
    screened = squares.astype(np.float32) - np.float32(2) * (small @ small_c.T)
    k = m + 12
    g = k * 2.0**-24 / (1 - k * 2.0**-24)
    length = np.sqrt((x * x).sum(axis=1).astype(np.float64)) * (1 + 2.0**-40)
    longest = np.sqrt(float(squares.max(initial=0))) * (1 + 2.0**-40)
    width = g * (2 * length * longest + longest * longest) * 2  # twice what the terms allow, for the last roundings
    reach = screened.min(axis=1).astype(np.float64) + 2 * width
    open_ = screened <= np.nextafter(reach.astype(np.float32), np.float32(np.inf))[:, None]
    many = open_.sum(axis=1) > 1
    index = open_.argmax(axis=1)
    difference = x - entries[index]
    distance = (difference * difference).sum(axis=1)
    again = 0
    if many.any():
        rows = np.flatnonzero(many)
        of, entry = np.nonzero(open_[rows])
        again = len(of)
        exact = np.empty(again, np.int64)
        for a in range(0, again, 1 << 16):
            d = x[rows[of[a : a + (1 << 16)]]] - entries[entry[a : a + (1 << 16)]]
            exact[a : a + (1 << 16)] = (d * d).sum(axis=1)
        start = np.searchsorted(of, np.arange(len(rows)))
        least = np.minimum.reduceat(exact, start)
        best = np.flatnonzero(exact == least[of])  # entries of a row stand in order of their index
        _, lead = np.unique(of[best], return_index=True)
        index[rows], distance[rows] = entry[best[lead]], least
    if counts is not None:
        counts["screened"] = counts.get("screened", 0) + n - int(many.sum())
        counts["again"] = counts.get("again", 0) + again
    return index, distance


def whole(vectors: pa.ListArray, length: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors count, and their components in whole numbers, padded to the length."""
    n = len(vectors)
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.slice(vectors.offsets[0].as_py(), int(size.sum()))
    value = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    row = np.repeat(np.arange(n), size)
    good = ~np.asarray(vectors.is_null())
    good[row[~np.isfinite(value)]] = False
    held = good[row]
    scaled = np.floor(value[held] * scale)
    if len(scaled) and np.abs(scaled).max() >= LARGEST * scale:
        raise ValueError(f"components of {LARGEST} and more don't fit in 64-bit sums of squares")
    out = np.zeros((n, length), np.int64)
    place = np.arange(len(value)) - np.repeat(np.cumsum(size) - size, size)
    out[row[held], place[held]] = scaled.astype(np.int64)
    return good, out[good]


# --- tables --------------------------------------------------------------------------------------


def _valid(vector_col: str):
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.col(vector_col).isNotNull() & F.forall(vector_col, fits)


def _starts(df: DataFrame, id_col: str, vector_col: str, length: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, component) of the vectors of least ids."""
    first = df.where(F.col(id_col).isNotNull() & _valid(vector_col)).orderBy(id_col, vector_col).limit(entries).select(vector_col).toArrow()
    column = first[vector_col].combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], first.schema.field(0).type)
    return np.stack(np.split(whole(column, length)[1], PARTS, axis=1))


def _moved(df: DataFrame, vector_col: str, length: int, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks with each entry at the floor of the mean of the parts nearest to it; unused ones as they were."""
    entries, width = codebooks.shape[1], length // PARTS
    sent = df.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches):
        books = sent.value
        sums, used = np.zeros((PARTS * entries, width), np.int64), np.zeros(PARTS * entries, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH_ROWS):
                _, x = whole(batch.column(0).slice(a, BATCH_ROWS), length)
                for part in range(PARTS if len(x) else 0):
                    own = x[:, part * width : (part + 1) * width]
                    index, _ = nearest(own, books[part])
                    np.add.at(sums, index + part * entries, own)
                    used += np.bincount(index + part * entries, minlength=PARTS * entries)
        met = np.flatnonzero(used)
        # one row for each component, and one (component -1) for the number of parts
        slot = np.concatenate([met, np.repeat(met, width)])
        component = np.concatenate([np.full(len(met), -1), np.tile(np.arange(width), len(met))])
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(component.astype(np.int32)), pa.array(np.concatenate([used[met], sums[met].ravel()]))], names=["slot", "component", "n"])

    rows = df.select(vector_col).mapInArrow(B.trimmed(run), "slot int, component int, n long").groupBy("slot", "component").agg(F.sum("n").alias("n")).toArrow()
    slot, component, n = (rows[c].to_numpy() for c in ("slot", "component", "n"))
    out, used, sums = codebooks.copy(), np.zeros(PARTS * entries, np.int64), np.zeros((PARTS * entries, width), np.int64)
    number = component < 0
    used[slot[number]] = n[number]
    sums[slot[~number], component[~number]] = n[~number]
    met = np.flatnonzero(used)
    out.reshape(PARTS * entries, width)[met] = sums[met] // used[met][:, None]  # floors, also below zero
    sent.destroy()
    return out


def trained(df: DataFrame, *, id_col="vec_id", vector_col="embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component), int64, after so many rounds over all vectors."""
    if not 0 < entries <= 256:
        raise ValueError("an index is one byte: 1 to 256 entries")
    longest = df.agg(F.max(F.when(_valid(vector_col), F.size(vector_col)))).first()[0] or 0
    length = -(-longest // PARTS) * PARTS
    codebooks = _starts(df, id_col, vector_col, length, entries)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = _moved(df, vector_col, length, codebooks)
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    """sha256 of all components in decimal, comma-joined, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


_NEW = {"code": "binary", "error": "long"}


def encoded(df: DataFrame, codebooks: np.ndarray, *, vector_col="embedding") -> DataFrame:
    """The other columns of the rows of ``df`` that count, with code (a byte for each part) and error (squared distance).

    Columns of ``df`` with these names are replaced.
    """
    others = [c for c in df.columns if c != vector_col and c not in _NEW]
    sent = df.sparkSession.sparkContext.broadcast(codebooks)
    parts, entries, width = codebooks.shape
    kept = df.select(*others, vector_col)

    def run(batches):
        books = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(a, BATCH_ROWS)
                good, x = whole(piece.column(len(others)), parts * width)
                code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
                for part in range(parts if len(x) and entries else 0):
                    index, distance = nearest(x[:, part * width : (part + 1) * width], books[part])
                    code[:, part] = index
                    error += distance
                rest = [piece.column(i).filter(pa.array(good)) for i in range(len(others))]
                made = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), len(x), [None, pa.py_buffer(code.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*rest, made, pa.array(error)], names=[*others, *_NEW])

    schema = kept.select(*others, *(F.lit(None).cast(t).alias(n) for n, t in _NEW.items())).schema
    return kept.mapInArrow(B.trimmed(run), schema)


def decoded(codes: np.ndarray, codebooks: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Vectors (float64) that codes (rows of one byte for each part) stand for."""
    return np.concatenate([codebooks[p][codes[:, p]] for p in range(len(codebooks))], axis=1) / scale


def with_label_error(df: DataFrame, label_col: str = "label", most: int = MOST_LABELS, salts: int = SALTS) -> DataFrame:
    """``df`` with label_error, the sum of error over rows of one label (null labels are one)."""
    df = df.drop("label_error")
    of, salt, dealt = fresh(df.columns, "_l"), fresh(df.columns, "_s"), fresh(df.columns, "_d")
    sums = stored(df.groupBy(F.col(label_col).alias(of)).agg(F.sum("error").alias("label_error")))
    if sums.count() <= most:
        return df.join(F.broadcast(sums), df[label_col].eqNullSafe(sums[of])).drop(of)
    rows = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    each = sums.withColumn(dealt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.join(each, rows[label_col].eqNullSafe(each[of]) & (rows[salt] == each[dealt])).drop(of, salt, dealt)


def query(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codebooks = trained(vectors)
    codes = stored(encoded(vectors, codebooks))
    done = with_label_error(codes)
    return done.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    return f"""a{k} AS MATERIALIZED (SELECT v.vec_id, v.p, min(list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + b.e) AS best FROM v JOIN b{k} b USING (p) GROUP BY ALL),
"""


def _move_sql(k: int) -> str:
    return f"""s{k} AS (SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT v.p, a.best % 256 AS e, unnest(v.x) AS x, unnest(range(1, len(v.x) + 1)) AS i FROM v JOIN a{k} a USING (vec_id, p)) GROUP BY ALL),
m{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{k} GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (p, e)),
"""


ORACLE = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, p, w[p * (len(w) // 4) + 1 : (p + 1) * (len(w) // 4)] AS x FROM k, range(4) r(p)),
o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k),
b0 AS MATERIALIZED (SELECT p, e, x FROM v JOIN o USING (vec_id) WHERE e < 256),
{"".join(_round_sql(k) + _move_sql(k) for k in range(ROUNDS))}{_round_sql(ROUNDS)}c AS (SELECT vec_id, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error FROM a{ROUNDS} GROUP BY 1),
h AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS codebooks_sha256 FROM (SELECT p, e, array_to_string(x, ',') AS t FROM b{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN k USING (vec_id), h
"""
