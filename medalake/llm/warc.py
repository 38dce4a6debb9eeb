"""WARC archives: writing pages, and reading records back along verified boundaries.

A payload may hold anything, also what looks like the start of a record. Tasks that read parts of
a file only find candidates: places of the magic with the offset where their record would end and
the next begin. Which candidates are records follows from the file's first one: the chain of
successors from there is found for all files at once by pointer jumping.
"""

from __future__ import annotations

import warnings
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from medalake.llm.common import stage, table
from medalake.session import _file_system, _shared_folder

# Fixed values of the format: magic (without the minor version), line end, end of a record.
MAGIC = "WARC/1."
LINE = "\r\n"
RECORD_END = "\r\n\r\n"
MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 2_000
# Up to so many fragments to put together are broadcast (about 200 bytes each).
BROADCAST_FRAGMENTS = 100_000
DATE = "1970-01-01T00:00:00Z"
RECORD_ID = "urn:medalake:page:"


def _line(name: str, value: Column) -> Column:
    """A header line. Line breaks in the value would end it and are percent-encoded."""
    safe = F.regexp_replace(value.cast("string"), "[\\r\\n\\x00]", "%20")
    return F.concat(F.lit(f"{name}: "), F.coalesce(safe, F.lit("")), F.lit(LINE))


def first_of_equals(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """``digest`` and ``first``: for payloads that occur more than once and have at least
    ``MIN_REVISIT_BYTES``, the least id among them. Only digests pass the shuffle."""
    bytes_ = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    digests = pages.select(F.col(key).alias("id"), F.sha2(bytes_, 256).alias("digest")).where(
        F.octet_length(bytes_) >= MIN_REVISIT_BYTES
    )
    grouped = digests.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    return grouped.where("n > 1").select("digest", "first")


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    records_per_file: int = RECORDS_PER_FILE, date: str = DATE,
) -> None:
    """Write a record for each row: a response with the payload, or a revisit of an equal one.

    Args:
        pages: rows; columns other than those named are left out. No rows write no records.
        key: integer id. Of equal payloads the least id is the response; rows that repeat it are
            responses too, and so is a null id, which compares with none.
        url: target, may be null. payload: text, written as UTF-8, a null one as empty.

    Records are plain, so that their offsets are the file's; tasks write through Spark's committer.
    """
    firsts = stage(first_of_equals(pages, key, payload))
    rows = pages.select(
        F.col(key).cast("bigint").alias("id"), F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("first") < F.col("id")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    id_of = lambda c: F.concat(
        F.lit(f"<{RECORD_ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">")
    )
    record = F.concat(
        F.lit(MAGIC + "1" + LINE),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", id_of(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, _line("WARC-Refers-To", id_of(F.col("first")))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(body)),
        F.lit(LINE), body,
    )
    rows.select(record.alias("value")).write.option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def _header(head: Column, name: str) -> Column:
    """Value of a header line, null if there is none."""
    found = F.regexp_extract(head, rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.nullif(F.rtrim(found), F.lit(""))


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at every magic, whole or in splits: ``file``, ``block`` (start of the split),
    ``n`` (order within it), ``value`` (bytes after a magic up to the next)."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), "value",
    )


def candidates(parts: DataFrame) -> DataFrame:
    """Every place of the magic as if a record began there.

    ``file``, ``at`` (its offset), ``next`` (offset after the record, null if the header is broken),
    the header's fields, ``length`` (of the content), and for content without a magic in it
    ``digest``, computed where the fragment was read; ``until`` (where the fragment ends). A header
    that does not end in its fragment is ``open``: a magic stands in it. Its ``stretch`` are the
    fragments up to the next blank line. Only these columns pass the shuffles.

    A split knows its fragments' sizes, and a file's splits add up from its start: the offset is
    the size of what comes before, first by split and then within one.
    """
    head = F.substring_index(F.col("value"), RECORD_END, 1)
    whole = F.locate(RECORD_END, F.col("value")) > 0
    content = F.substr("value", F.length("head") + F.lit(len(RECORD_END) + 1))
    sound = F.col("value").rlike(r"\A[01]\r\n") & whole
    size = F.octet_length("value").cast("bigint")
    facts = parts.select(
        "file", "block", "n", size.alias("size"), F.when(sound, head).alias("head"), "value"
    ).withColumn("length", _header(F.col("head"), "Content-Length").try_cast("bigint"))
    # Content by bytes: the content ends with the record, or with the end of the fragment.
    facts = facts.withColumn("body", F.when(F.col("head").isNotNull(), content).cast("binary"))
    held = F.octet_length("body")
    ended = F.when(
        held >= F.col("length"), F.substring("body", F.lit(1), F.col("length").cast("int"))
    )
    facts = facts.select(
        "file", "block", "n", "size", "length", whole.alias("ended"),
        (F.col("value").rlike(r"\A[01]\r\n[!-9;-~]+:") & ~whole).alias("open"),
        (F.octet_length("head") + len(RECORD_END)).cast("bigint").alias("head_size"),
        _header(F.col("head"), "WARC-Type").alias("type"),
        _header(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _header(F.col("head"), "WARC-Target-URI").alias("uri"),
        _header(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        _header(F.col("head"), "WARC-Payload-Digest").alias("claimed"),
        F.sha2(ended, 256).alias("digest"),
    )
    magic = len(MAGIC)
    closed = F.col("ended").cast("bigint")
    splits = facts.groupBy("file", "block").agg(
        F.sum(F.col("size") + magic).alias("split_size"), F.sum(closed).alias("split_closed")
    )
    by_file = Window.partitionBy("file").orderBy("block")
    splits = splits.select(
        "file", "block", (F.sum("split_size").over(by_file) - F.col("split_size")).alias("before"),
        (F.sum("split_closed").over(by_file) - F.col("split_closed")).alias("closed_before"),
    )
    inside = Window.partitionBy("file", "block").orderBy("n")
    placed = facts.join(splits, ["file", "block"]).withColumns({
        "end": F.col("before") + F.sum(F.col("size") + magic).over(inside),
        "stretch": F.col("closed_before") + F.sum(closed).over(inside) - closed,
    })
    # ``end`` is where the next magic's text would end; the fragment's own magic ends before it.
    start = F.col("end") - F.col("size") - magic
    return placed.select(
        "file", "block", "n", (start - magic).alias("at"),
        (start + F.col("head_size")).alias("content_at"),
        (start + F.col("head_size") + F.col("length") + len(RECORD_END)).alias("next"),
        "length", "type", "record_id", "uri", "refers_to", "claimed", "digest",
        "open", "ended", "stretch", (F.col("end") - magic).alias("until"),
    ).where("at >= 0")


def with_open_headers(parts: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the headers that a magic cuts, put together from their fragments up to the
    blank line that ends them. A header that never ends stays without a ``next``.

    Only stretches with an open header are fetched again, each once; a stretch is what stands
    between two blank lines.
    """
    opened = found.where("open")
    if opened.isEmpty():
        return found
    wanted = opened.select("file", "stretch").distinct()
    places = found.join(wanted, ["file", "stretch"]).select("file", "stretch", "block", "n", "at", "ended")
    value = F.substring_index("value", RECORD_END, 1)
    pieces = places.join(parts.select("file", "block", "n", value.alias("v")), ["file", "block", "n"])
    texts = pieces.groupBy("file", "stretch").agg(
        F.array_sort(F.collect_list(F.struct("at", "v"))).alias("pieces"),
        F.min("at").alias("from"), F.max("ended").alias("closes"),
    ).where("closes").select(
        "file", "stretch", "from",
        F.concat_ws(MAGIC, F.transform("pieces", lambda p: p["v"])).cast("binary").alias("raw"),
    )
    start = (F.col("at") - F.col("from") + 1).cast("int")
    head = F.substr("raw", start, F.octet_length("raw")).cast("string")
    names = {
        "type": "WARC-Type", "record_id": "WARC-Record-ID", "uri": "WARC-Target-URI",
        "refers_to": "WARC-Refers-To", "claimed": "WARC-Payload-Digest",
    }
    rest = [c for c in opened.columns if c not in (*names, "length", "content_at", "next", "digest")]
    # Its content lies in later fragments, so its digest is taken when they are put together.
    whole = opened.select(*rest).join(texts, ["file", "stretch"], "left").withColumn("head", head).select(
        *rest, *[_header(F.col("head"), name).alias(c) for c, name in names.items()],
        _header(F.col("head"), "Content-Length").try_cast("bigint").alias("length"),
        (F.col("at") + len(MAGIC) + F.octet_length("head") + len(RECORD_END)).cast("bigint")
        .alias("content_at"), F.lit(None).cast("string").alias("digest"),
    ).withColumn("next", F.col("content_at") + F.col("length") + len(RECORD_END))
    return found.where("NOT open").unionByName(whole)


def broken_chains(found: DataFrame, records: DataFrame) -> DataFrame:
    """``file``, ``reached`` and ``size`` of the files whose chain ends before the file does."""
    sizes = found.groupBy("file").agg(F.max("until").alias("size"))
    ends = records.groupBy("file").agg(F.max("next").alias("reached"))
    reached = F.coalesce("reached", F.lit(0).cast("bigint"))
    return sizes.join(ends, "file", "left").select("file", reached.alias("reached"), "size").where(
        "reached < size"
    )


def reachable(links: DataFrame) -> DataFrame:
    """``file`` and ``at`` of the candidates on the chain from offset 0 of each file.

    ``links`` has ``file``, ``at``, ``next``. In round k every candidate points 2**k records ahead,
    and what is reached grows by where its pointers lead, so rounds grow with the logarithm of the
    longest chain. Each round is stored.
    """
    pointers = stage(links.where("next > at").select("file", "at", "next"))
    reached = stage(links.where("at = 0").select("file", "at").distinct())
    nodes = stage(links.select("file", F.col("at").alias("next")))
    # A pointer that leads to no candidate ends its chain.
    pointers = stage(pointers.join(nodes, ["file", "next"], "left_semi"))
    while not pointers.isEmpty():
        ahead = reached.join(pointers, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = stage(reached.union(ahead))
        step = pointers.select("file", F.col("at").alias("next"), F.col("next").alias("then"))
        pointers = stage(
            pointers.join(step, ["file", "next"]).select("file", "at", F.col("then").alias("next"))
        )
    return reached


def read_archives(
    spark: SparkSession, path: str, payloads: bool = False, broken: str = "warn"
) -> DataFrame:
    """Records of all files under ``path``, in any order.

    Returns ``file``, ``at``, ``type``, ``record_id``, ``uri``, ``refers_to``, ``claimed`` (digest in
    the header), ``length`` bigint, ``digest`` (SHA-256 of the content as read) and with
    ``payloads`` the content as ``payload`` (binary). A file whose chain breaks off gives the
    records up to there; bytes that no chain reaches are no records. Such files are named in a
    warning, or with ``broken="fail"`` in an error.
    """
    parts = fragments(spark, path)
    found = stage(with_open_headers(parts, stage(candidates(parts))))
    kept = reachable(found.select("file", "at", "next"))
    records = found.join(kept, ["file", "at"])
    some = broken_chains(found, records).orderBy("file").limit(10).collect()
    if some:
        told = ", ".join(f"{r.file} after byte {r.reached} of {r.size}" for r in some)
        if broken == "fail":
            raise ValueError(f"records are lost where chains break off: {told}")
        warnings.warn(f"chains break off: {told}", stacklevel=2)
    found, records = (df.drop("open", "ended", "stretch", "until") for df in (found, records))
    if not payloads:
        records = records.where("digest IS NOT NULL").unionByName(
            _rejoined(parts, found, records.where("digest IS NULL")).drop("payload")
        )
    else:
        records = _rejoined(parts, found, records)
    return records.drop("block", "n", "content_at", "next")


def _rejoined(parts: DataFrame, found: DataFrame, records: DataFrame) -> DataFrame:
    """Records with their content put together from the fragments that it spans.

    A content that holds the magic was cut there. Its fragments are those between the record's
    content and its end, at most all of the record, which is one row anyway.
    """
    records = stage(records)
    spans = records.select("file", "at", "content_at", "next", F.col("length").alias("long"))
    # A fragment belongs to the last record that begins at or before it.
    starts = found.select("file", F.col("at").alias("place"), "block", "n").join(
        records.select("file", F.col("at").alias("place"), F.lit(True).alias("begins")),
        ["file", "place"], "left",
    )
    # Files are bounded by their number of records, so one file's fragments are one window.
    before = Window.partitionBy("file").orderBy("place")
    owner = F.last(F.when(F.col("begins"), F.col("place")), ignorenulls=True).over(before)
    owned = starts.withColumn("at", owner).join(spans, ["file", "at"]).where("place < next")
    owned = stage(owned.select("file", "block", "n", "at", "place"))
    # Few contents hold a magic; then the bytes of all others stay where they are read.
    few = owned.count() <= BROADCAST_FRAGMENTS
    pieces = parts.join(F.broadcast(owned) if few else owned, ["file", "block", "n"])
    joined = pieces.groupBy("file", "at").agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("value").cast("binary").alias("v"))))
        .alias("pieces")
    ).withColumn("raw", F.concat_ws(
        MAGIC, F.transform("pieces", lambda p: p["v"].cast("string"))
    ).cast("binary"))
    content = F.substring(
        "raw", (F.col("content_at") - F.col("at") - len(MAGIC) + 1).cast("int"),
        F.col("length").cast("int"),
    )
    return records.join(joined.select("file", "at", "raw"), ["file", "at"]).withColumn(
        "payload", content
    ).withColumn("digest", F.sha2("payload", 256)).select(*records.columns, "payload")


def _page_of(record_id: Column) -> Column:
    return F.nullif(
        F.regexp_extract(record_id, rf"^<{RECORD_ID}(-?\d*)>$", 1), F.lit("")
    ).cast("bigint")


def page_records(records: DataFrame) -> DataFrame:
    """Records of ``write_archives`` by page: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``. A revisit has the size and digest of the response it refers to.

    A response that a third of all records revisit is one row, joined to a revisit side that
    adaptive execution can split."""
    rows = stage(records.select(
        _page_of(F.col("record_id")).alias("page_id"), F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        _page_of(F.col("refers_to")).alias("refers_to"),
    ))
    responses = rows.where("record_type = 'response'")
    # Repeats of a response are equal, so any stands for them.
    known = responses.where("page_id IS NOT NULL").groupBy(F.col("page_id").alias("refers_to")).agg(
        F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest")
    )
    revisits = rows.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to")
    resolved = revisits.join(known, "refers_to", "left")
    return responses.unionByName(resolved)


def op5_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page into archives, read them back, and return each page's record."""
    path = f"{_shared_folder(spark)}/medalake-warc-{uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.deleteOnExit(target)
    write_archives(table(spark, sf_dir, "pages"), path)
    return page_records(read_archives(spark, path, broken="fail"))


OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), firsts AS (
  SELECT html AS h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY html
)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN firsts ON h = html
"""
