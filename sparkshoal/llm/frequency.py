"""Frequency of every distinct value or term by external sort.

(term, record, occurrence) triples are range-partitioned and sorted on all
three columns, so a hot term spreads over many partitions and equal triples
stay together. One scan of each sorted partition measures runs: triples give
occurrences, (term, record) runs give records. A run of a record that goes on
in the next partition is counted where it begins: each partition reports its
first and last run, and ends that meet are joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkshoal.functions.text import is_blank
from sparkshoal.session import table

_RUNS = "field string, term string, occurrences long, records long, head_record long, tail_record long, part int"


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """True at each row that differs from the one before in any column (the first row always)."""
    n = len(columns[0])
    out = np.zeros(n, dtype=bool)
    out[:1] = True
    for c in columns:
        if n > 1:
            ne = pc.not_equal(c.slice(1), c.slice(0, n - 1))
            null = pc.xor(pc.is_null(c.slice(1)), pc.is_null(c.slice(0, n - 1)))
            out[1:] |= pc.or_(pc.fill_null(ne, False), null).to_numpy(zero_copy_only=False)
    return out


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Run lengths over one sorted partition: a row for each term, its end records kept for joining partitions."""
    last: tuple | None = None  # last triple seen
    run: list | None = None  # open term: field, term, occurrences, records, head, tail, part
    rows: list[list] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        field, term, rec, occ, part = (b.column(i) for i in range(5))
        new_term, new_rec, new_occ = _changes([field, term]), _changes([field, term, rec]), _changes([field, term, rec, occ])
        first = (field[0].as_py(), term[0].as_py(), rec[0].as_py(), occ[0].as_py())
        if last is not None:
            new_term[0], new_rec[0], new_occ[0] = first[:2] != last[:2], first[:3] != last[:3], first != last
        known = ~pc.is_null(rec).to_numpy(zero_copy_only=False)
        new_rec &= known
        starts = np.flatnonzero(new_term)
        cuts = starts if len(starts) and starts[0] == 0 else np.concatenate(([0], starts))
        occs, recs = np.add.reduceat(new_occ, cuts, dtype=np.int64), np.add.reduceat(new_rec, cuts, dtype=np.int64)
        ends = np.append(cuts[1:], b.num_rows) - 1
        for k, (lo, hi) in enumerate(zip(cuts.tolist(), ends.tolist())):
            if new_term[lo] or run is None:
                if run is not None:
                    rows.append(run)
                run = [field[lo].as_py(), term[lo].as_py(), 0, 0, rec[lo].as_py(), None, part[lo].as_py()]
            run[2] += int(occs[k])
            run[3] += int(recs[k])
            run[5] = rec[hi].as_py()
        end = b.num_rows - 1
        last = (field[end].as_py(), term[end].as_py(), rec[end].as_py(), occ[end].as_py())
        if len(rows) > 50_000:
            yield _batch(rows)
            rows = []
    if run is not None:
        rows.append(run)
    if rows:
        yield _batch(rows)


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    names = ["field", "term", "occurrences", "records", "head_record", "tail_record", "part"]
    return pa.RecordBatch.from_arrays([pa.array(x, type=k) for x, k in zip(zip(*rows), kinds)], names=names)


def term_counts(triples: DataFrame) -> DataFrame:
    """Occurrences and distinct records of every term of every field.

    ``triples`` has field, term (strings), record (long), occurrence (long).
    Equal triples are one occurrence; a null term is left out; a null record is
    an occurrence in no record. Terms are compared exactly as stored. Result:
    field, term, occurrences, records; no rows for an empty input.
    """
    keys = ["field", "term", "record", "occurrence"]
    ranged = triples.where("term is not null").select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    runs = ranged.withColumn("part", F.spark_partition_id()).mapInArrow(_scan, _RUNS)
    # Equal ranges never straddle partitions on all four columns, but a record's occurrences may: if a term's run ends with the record the next one starts with, that record counts once.
    before = F.lag("tail_record").over(Window.partitionBy("field", "term").orderBy("part"))
    joined = runs.withColumn("again", F.coalesce((before == F.col("head_record")).cast("long"), F.lit(0)))
    return joined.groupBy("field", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum(F.col("records") - F.col("again")).alias("records"))


def marked(triples: DataFrame, rare: int = 2, common: float = 0.04) -> DataFrame:
    """``term_counts`` with a mark: rare (at most ``rare`` records), common (more than the share ``common`` of its field's records), else null."""
    totals = triples.where("term is not null and record is not null").select("field", "record").distinct().groupBy("field").agg(F.count("*").alias("total"))
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") > F.lit(common) * F.coalesce("total", F.lit(0)), "common")
    return term_counts(triples).join(totals, "field", "left").select("field", "term", "occurrences", "records", mark.alias("mark"))


def project_terms(boxes: DataFrame, progress: DataFrame) -> DataFrame:
    """Labels of boxes (record: the sample) and concepts of progress (record: the line) as triples; blank ones are left out."""
    a = boxes.where(~is_blank(F.col("label"))).select(F.lit("label").alias("field"), F.col("label").alias("term"), F.col("sample_id").alias("record"), F.col("box_id").alias("occurrence"))
    b = progress.where(~is_blank(F.col("concept"))).select(F.lit("concept").alias("field"), F.col("concept").alias("term"), F.col("rec_id").alias("record"), F.col("rec_id").alias("occurrence"))
    return a.unionByName(b)


def p4_found(spark, sf_dir: str) -> DataFrame:
    return p4_terms(spark, sf_dir).where("mark is not null").select("field", "term", "mark")


def p4_terms(spark, sf_dir: str) -> DataFrame:
    return marked(project_terms(table(spark, sf_dir, "boxes"), table(spark, sf_dir, "progress")))
