"""Incremental article intake (T1, J7, G3, K5) as Structured Streaming.

Landed pages arrive as files in a directory. The stream

1. keeps one page per (company, link): the smallest page id of the batch that
   brings the link first. What was seen is state, one long per (company, link)
   in the state store of the link's partition; no list is read again (J7);
2. dates the page (F12, X1); a page without a date is no article, but its link
   counts as seen (Q12);
3. runs page text -> summary -> keywords -> counts (G1, G2, X8);
4. writes the batch's keyword rows under its batch id with dynamic partition
   overwrite, so a replayed batch replaces its own output (exactly-once with the
   query checkpoint).

An intake folder holds generations, each with its own store and checkpoint.
``extend`` goes on with the newest one and adds articles of unseen links,
``reset`` starts the next one with an empty state, ``keep`` processes nothing.
Readers take the newest generation; old ones stay until someone drops them.

The batch form :func:`article_store` gives the same rows for the same pages.
"""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.harvest import company_of, dated_pages, page_text
from ..operators.keywords import extract_keywords, keyword_counts, keyword_phrases
from ..operators.text import summaries
from ..session import ensure_checkpoint_dir, written

PAGE_SCHEMA = "page_id long, url string, html string"


def first_per_link(pages: DataFrame) -> DataFrame:
    """One page per (company, link): the smallest page id."""
    p = pages.select(company_of().alias("company"), "page_id", F.col("url").alias("link"), "html")
    first = p.groupBy("company", "link").agg(F.min("page_id").alias("page_id"))
    return p.join(first, ["company", "link", "page_id"], "left_semi")


def article_keywords(fresh: DataFrame, sep: str = " ") -> DataFrame:
    """G3 on one page per link (company, link, page_id, html): ``company, link,
    page_id, pub_date, keyword, cnt`` of the pages that carry a date."""
    pages = fresh.select("company", "page_id", F.col("link").alias("url"), "html")
    dates = dated_pages(pages).select("page_id", "pub_date")
    txt = page_text(pages.join(dates, "page_id", "left_semi"), sep)
    docs = written(txt.select(F.col("page_id").alias("doc_id"), "text"), "page-texts")
    summ = written(summaries(docs), "summaries")
    kw = written(extract_keywords(summ), "keywords")
    counts = keyword_counts(summ, kw, keyword_phrases(summ, kw)).withColumnRenamed("doc_id", "page_id")
    return (counts.join(dates, "page_id").join(fresh.select("company", "link", "page_id"), "page_id")
            .select("company", "link", "page_id", "pub_date", "keyword", "cnt"))


def article_store(pages: DataFrame) -> DataFrame:
    """Batch form of the intake."""
    return article_keywords(first_per_link(pages))


def _scratch(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"ticktale-{name}-{uuid.uuid4().hex}")


def page_chunks(pages: DataFrame, chunks: int = 4) -> list[DataFrame]:
    """The pages by page id range, the way a fetcher would land them over time."""
    n = pages.agg(F.max("page_id").alias("m")).collect()[0].m or 0
    step = n // chunks + 1
    return [pages.filter((F.col("page_id") >= i * step) & (F.col("page_id") < (i + 1) * step)) for i in range(chunks)]


def land_pages_in_chunks(pages: DataFrame, path: str, chunks: int = 4) -> None:
    """Test helper: write the chunks one after the other."""
    for part in page_chunks(pages, chunks):
        part.write.mode("append").parquet(path)


FRESH = "company string, link string, page_id long, html string"


def _first_seen(key, chunks, state):
    """The page of a link's first batch with the smallest id, once; chunk by
    chunk, so that any number of copies may arrive together."""
    best = None
    if not state.exists:
        for c in chunks:
            i = c["page_id"].idxmin()
            if best is None or c.at[i, "page_id"] < best[0]:
                best = (c.at[i, "page_id"], c.at[i, "html"])
    if best is not None:
        state.update((int(best[0]),))
        yield pd.DataFrame({"company": [key[0]], "link": [key[1]], "page_id": [best[0]], "html": [best[1]]})


def unseen_pages(pages: DataFrame) -> DataFrame:
    """Streaming J7: one page per (company, link), never again for that link."""
    p = pages.filter("page_id IS NOT NULL").select(company_of().alias("company"), F.col("url").alias("link"), "page_id", "html")
    return p.groupBy("company", "link").applyInPandasWithState(_first_seen, FRESH, "page_id long", "append", "NoTimeout")


def _generations(root: str) -> str:
    return os.path.join(root, "generations")


def newest_generation(spark: SparkSession, root: str, start: bool = False) -> int:
    """Number of the newest generation below ``root``; ``start`` adds the next."""
    path = _generations(root)
    spark.createDataFrame([], "generation long").write.mode("append").parquet(path)
    last = spark.read.schema("generation long").parquet(path).agg(F.max("generation")).first()[0]
    if start or last is None:
        last = 0 if last is None else last + 1
        spark.range(last, last + 1, numPartitions=1).toDF("generation").write.mode("append").parquet(path)
    return last


STORE = "company string, link string, page_id long, pub_date date, keyword string, cnt long, batch_id long"


def _store_of(root: str, generation: int) -> str:
    return os.path.join(root, f"generation-{generation}", "store")


def read_intake(spark: SparkSession, root: str) -> DataFrame:
    """The keyword rows of the newest generation."""
    path = _store_of(root, newest_generation(spark, root))
    spark.createDataFrame([], STORE).write.mode("append").partitionBy("batch_id").parquet(path)
    return spark.read.schema(STORE).parquet(path).drop("batch_id")


def start_intake(spark: SparkSession, landing: str, root: str, mode: str = "extend", once: bool = True,
                 max_files: int | None = None):
    """Start the intake from ``landing`` into the folder ``root``; returns the
    streaming query (None for ``keep``)."""
    if mode not in ("extend", "reset", "keep"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "keep":
        return None
    generation = newest_generation(spark, root, start=mode == "reset")
    store = _store_of(root, generation)
    reader = spark.readStream.schema(PAGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def process(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.checkpoint()          # the state moves once a batch, its pages are read several times
        (article_keywords(fresh).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(store))

    w = unseen_pages(reader.parquet(landing)).writeStream.foreachBatch(process).outputMode("append").option(
        "checkpointLocation", os.path.join(root, f"generation-{generation}", "checkpoint"))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()


def q_incremental_articles(spark: SparkSession, pages: DataFrame, chunks: int = 4) -> DataFrame:
    """Run the intake over the pages landed in ``chunks`` chunks, each taken up
    as a whole once it has landed (Spark writes a file for every split of the
    pages; a batch for each would multiply the batches by the splits); return
    the store's keyword rows (equal to :func:`article_store`)."""
    landing, root = _scratch(spark, "landing"), _scratch(spark, "intake")
    for part in page_chunks(pages, chunks):
        part.write.mode("append").parquet(landing)
        start_intake(spark, landing, root).awaitTermination()
    return read_intake(spark, root)
