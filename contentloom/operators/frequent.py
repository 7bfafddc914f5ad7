"""The most frequent words without a count of all words: summaries by task, then an exact recount.

A task keeps at most ``counters`` words. When there are more, the count of the next one is taken off
all and words without a rest go; what was taken off in all is the task's error. So a word's kept count
is below its true one by the error at most, and a word that was not kept has occurred no more often
than the error says. Summaries add up, and so do their errors.

Words that may be among the most frequent are then counted exactly. If the last of them is more
frequent than any other word can be, nothing else can be among them. If not, all words are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentloom.operators.topics import TopicSettings, counted_terms, flagged_terms, vocabulary

COUNTERS = 20_000
#: Times as many words are recounted as are wanted.
SPARE = 4


def _reduced(table: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """At most ``counters`` of the counted words, and what was taken off the count of each."""
    if table.num_rows <= counters:
        return table, 0
    counts = np.asarray(table.column("n"))
    off = int(np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1])
    kept = table.filter(pa.array(counts > off))
    return kept.set_column(1, "n", pc.subtract(kept.column("n"), off)), off


def _added(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by("term").aggregate([("n", "sum")])
    return found.select(["term", "n_sum"]).rename_columns(["term", "n"])


def summaries(corpus: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """term, n (a lower bound of its count in the task), error; one row with a NULL term and the error
    of each task. ``corpus`` has an array ``words`` in each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, error = pa.table({"term": pa.array([], pa.string()), "n": pa.array([], pa.int64())}), 0
        for batch in batches:
            found = pc.value_counts(batch.column("words").flatten().drop_null())
            own = pa.table({"term": found.field("values").cast(pa.string()), "n": found.field("counts")})
            kept, off = _reduced(_added([kept, own]), counters)
            error += off
        last = pa.table({"term": pa.array([None], pa.string()), "n": pa.array([0], pa.int64())})
        for part in pa.concat_tables([kept, last]).combine_chunks().to_batches():
            ends = np.asarray(pc.is_null(part.column("term")))
            yield pa.RecordBatch.from_arrays(
                [part.column("term"), part.column("n"), pa.array(np.where(ends, error, 0))], ["term", "n", "error"]
            )

    return corpus.select("words").mapInArrow(run, "term string, n long, error long")


def frequent_vocabulary(
    corpus: DataFrame, settings: TopicSettings = TopicSettings(), counters: int = COUNTERS
) -> DataFrame:
    """``vocabulary`` by summaries: the same rows in every case. Runs jobs, and reads ``corpus`` twice,
    or three times where the summaries do not decide; so a corpus that is costly to make is stored first.

    The shuffle of the summaries has ``counters`` rows a task at most, that of the recount
    ``SPARE * vocabulary_size``, however many different words there are.
    """
    spark = corpus.sparkSession
    wanted = settings.vocabulary_size * SPARE
    found = summaries(corpus, counters)
    # A plan of bounded rows: read once here and kept as a table of the few best.
    totals = found.groupBy("term").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))
    best = totals.orderBy(F.col("term").isNull().desc(), F.desc("n"), "term").limit(wanted + 2).collect()
    error = best[0].error if best and best[0].term is None else 0
    terms = [row for row in best if row.term is not None]
    # The most that a word can have which is not recounted.
    others = error + (terms[wanted].n if len(terms) > wanted else 0)
    if not terms:
        return vocabulary(corpus, settings)
    chosen = spark.createDataFrame([(row.term,) for row in terms[:wanted]], "term string")
    listed = flagged_terms(corpus).join(F.broadcast(chosen), "term", "left_semi")
    exact = (
        counted_terms(listed)
        .filter(F.col("document_count") >= settings.min_documents)
        .orderBy(F.desc("term_count"), F.asc("term"))
        .limit(settings.vocabulary_size)
        .collect()
    )
    if len(exact) == settings.vocabulary_size and exact[-1].term_count > others:
        return spark.createDataFrame(exact, "term string, term_count bigint, document_count bigint")
    return vocabulary(corpus, settings)
