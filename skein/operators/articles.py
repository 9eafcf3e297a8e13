"""From stored pages to a clean article table."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.fixed import (ARTICLE_SELECTORS, DEFAULT_OFFSET, KNOWN_OFFSETS, LINK_SELECTORS,
                                   TIME_ATTRIBUTE)
from skein.functions.html import pick, steps
from skein.functions.skew import lookup
from skein.operators.dedupe import comparable, dedupe_greedy
from skein.session import cut

ARTICLE_SCHEMA = ("url string, title string, text array<string>, tags array<string>, "
                  "photo_count int, time string, comment_count int")


# Bytes of html a Python task takes apart before it hands records on; a larger page is taken alone.
PIECE_BYTES = 4 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes in a column."""
    for batch in batches:
        start = held = 0
        for at, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if at > start and held + size > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def extract_articles(pages: DataFrame, rules: dict[str, str] | None = None,
                     time_attribute: str = TIME_ATTRIBUTE) -> DataFrame:
    """Article record of every page of ``pages(url, html)``.

    ``rules`` maps the parts of an article to selectors; a part without a selector stays empty. The
    text is a list: the opener, then each paragraph.
    """
    rules = ARTICLE_SELECTORS if rules is None else rules

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = {part: steps(selector) for part, selector in rules.items()}
        for batch in pieces(batches, "html"):
            records = [
                article_record(url, pick(html, paths), time_attribute)
                for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())
            ]
            yield pa.RecordBatch.from_pylist(records, schema=arrow_article_schema())

    return pages.select("url", "html").mapInArrow(parse, ARTICLE_SCHEMA)


def arrow_article_schema() -> pa.Schema:
    texts = pa.list_(pa.string())
    return pa.schema([("url", pa.string()), ("title", pa.string()), ("text", texts), ("tags", texts),
                      ("photo_count", pa.int32()), ("time", pa.string()), ("comment_count", pa.int32())])


def article_record(url: str, parts: dict[str, list], time_attribute: str) -> dict:
    """One article from the elements found on its page."""
    texts = {part: [text for text, _ in hits] for part, hits in parts.items()}
    times = [attrs.get(time_attribute) for _, attrs in parts.get("time", [])]
    return {
        "url": url,
        "title": " ".join(texts.get("title", [])),
        "text": [" ".join(texts.get("opener", [])), *texts.get("paragraphs", [])],
        "tags": texts.get("tags", []),
        "photo_count": first_number(texts.get("photo_count", [])),
        "time": times[0] if times else None,
        "comment_count": first_number(texts.get("comment_count", [])),
    }


def first_number(texts: list[str]) -> int | None:
    """First run of digits, 0 when there is none, null when it is beyond the range of an int."""
    digits = re.search(r"\d+", " ".join(texts))
    if not digits:
        return 0
    # Thousands of digits are no number to Python, so length is looked at first.
    shorter = re.sub(r"^0+(?=\d)", "", digits.group())
    return int(shorter) if len(shorter) <= 10 and int(shorter) < 1 << 31 else None


def extract_links(pages: DataFrame, selectors: tuple[str, ...] = LINK_SELECTORS[:1],
                  key: str = "page_id") -> DataFrame:
    """One row ``(key, href)`` per article link of every page, percent-decoded."""
    key_type = pages.select(key).schema[0]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = {selector: steps(selector) for selector in selectors}
        for batch in pieces(batches, "html"):
            keys, hrefs = [], []
            for at, html in enumerate(batch.column("html").to_pylist()):
                found = [attrs.get("href") for hits in pick(html, paths).values() for _, attrs in hits]
                links = [unquote(href) for href in found if href]
                keys += [at] * len(links)
                hrefs += links
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(keys, pa.int64())), pa.array(hrefs, pa.string())],
                names=[key, "href"])

    schema = f"`{key}` {key_type.dataType.simpleString()}, href string"
    return pages.select(key, "html").mapInArrow(parse, schema)


def frontier(links: DataFrame, finished: DataFrame, link: str = "href", done: str = "url") -> DataFrame:
    """Links not finished yet, each once. Repeats collapse before the join, so its keys are unique."""
    known = finished.select(F.col(done).alias(link)).distinct()
    return links.select(link).distinct().join(known, link, "left_anti")


def with_category(df: DataFrame, prefix: str, url: str = "url") -> DataFrame:
    """Category = first path segment of urls under ``prefix``, null elsewhere."""
    path = F.expr(f"substring({quoted(url)}, {len(prefix) + 1})")
    return df.withColumn(
        "category", F.when(F.col(url).startswith(prefix), F.split_part(path, F.lit("/"), F.lit(1))))


def flatten_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Paragraph list to one text with a line per paragraph."""
    return df.withColumn(text, F.array_join(text, "\n"))


def normalise_time(df: DataFrame, default_now: str | None = None, default_offset: str = DEFAULT_OFFSET,
                   time: str = "time") -> DataFrame:
    """Give every time an offset; a missing time becomes ``default_now`` (the present, in UTC)."""
    present = F.lit(default_now) if default_now else F.concat(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                      "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    written = F.col(time)
    has_offset = F.right(written, F.lit(len(default_offset))).isin(*KNOWN_OFFSETS)
    return df.withColumn(
        time,
        F.when(written.isNull() | (written == ""), present)
        .when(has_offset, written)
        .otherwise(F.concat(written, F.lit(default_offset))))


def append_articles(new: DataFrame, store: str, order: str, keys: tuple[str, ...] = ("url", "title"),
                    partition_by: str | None = None) -> DataFrame:
    """Append the articles not yet in the Parquet store at ``store``; returns what was appended.

    A new article is left out when it shares a key with a stored one or with an earlier new one. Of the store only
    the key columns are read, and only rows that meet a key of the batch go on: a batch measured small is broadcast
    to that scan, so nothing of the store is shuffled. ``partition_by`` lays the store out in folders.
    """
    marks = {f"_{k}": comparable(k) for k in keys}
    fresh = new.withColumns(marks)
    stored = read_store(new.sparkSession, store)
    if stored is not None:
        fresh = cut(fresh)
        for k, mark in zip(keys, marks):
            wanted = fresh.select(mark).distinct()
            known = lookup(stored.select(comparable(k).alias(mark)), wanted, mark, "left_semi").distinct()
            fresh = lookup(fresh, cut(known), mark, "left_anti")
    kept = cut(dedupe_greedy(fresh.drop(*marks), list(keys), order))
    writer = kept.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(store)
    return kept


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """The article store, or None before the first append."""
    try:
        return spark.read.parquet(store)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replicate(df: DataFrame, at_least: int) -> DataFrame:
    """The whole table repeated until it has at least ``at_least`` rows, with a ``copy`` number."""
    rows = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1)))
    copies = F.ceil(F.lit(at_least) / rows.scalar())
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))


def export_text(df: DataFrame, path: str, at_least: int = 50_000, text: str = "text") -> None:
    """Write the texts as plain lines, the whole table as often as needed to reach ``at_least``."""
    replicate(df.select(text), at_least).select(text).write.text(path)
