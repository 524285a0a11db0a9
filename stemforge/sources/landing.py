"""Landing of JSON and text sources: bad files are counted, never dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc VARIANT, bad): one row per file of a folder; a half-written or foreign file has a null doc and bad = true."""
    return json_docs(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value"))


def json_docs(texts: DataFrame) -> DataFrame:
    """(file, doc VARIANT, bad) of texts (file, value)."""
    return texts.select("file", F.try_parse_json("value").alias("doc"), F.try_parse_json("value").isNull().alias("bad"))


def json_items(files: DataFrame) -> DataFrame:
    """(file, pos, item VARIANT) of the shapes a list, {items: [...]}, {questions: [...]}, {explanations: [...]} or a single object; another shape raises."""
    shape = F.schema_of_variant("doc")
    pick = lambda path: F.try_variant_get("doc", path, "array<variant>")
    items = F.coalesce(pick("$"), pick("$.items"), pick("$.questions"), pick("$.explanations"), F.when(shape.startswith("OBJECT"), F.array("doc")))
    known = F.when(items.isNull(), F.raise_error(F.concat(F.lit("unknown shape in "), F.col("file")))).otherwise(items)
    return files.where(~F.col("bad")).select("file", F.posexplode(known).alias("pos", "item"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) in file order."""
    return lines_of(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value"))


def lines_of(texts: DataFrame) -> DataFrame:
    """(file, line_no, line) of texts (file, value)."""
    return texts.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def draft_items(texts: DataFrame, header: str = "Q:") -> DataFrame:
    """(file, qid, text) of drafts whose items begin with a header line ``Q: id``; what stands before the first is left out."""
    parts = F.slice(F.split("value", rf"(?m)^{header}[ \t]*"), 2, 1_000_000)
    return texts.select("file", F.explode(parts).alias("p")).select("file", F.trim(F.regexp_extract("p", r"^([^\n]*)", 1)).alias("qid"), F.regexp_replace(F.regexp_replace("p", r"^[^\n]*\n?", ""), r"\s+$", "").alias("text"))


def table_cells(lines: DataFrame) -> DataFrame:
    """(file, line_no, cell_no, cell): non-empty cells of lines with at least two bars; separator rows are left out."""
    rows = lines.where(F.regexp_count("line", F.lit(r"\|")) >= 2).where(~F.col("line").rlike(r"^[\s|:\-]+$"))
    cells = rows.select("file", "line_no", F.posexplode(F.split("line", r"\|")).alias("cell_no", "cell"))
    return cells.select("file", "line_no", "cell_no", F.trim("cell").alias("cell")).where("cell <> ''")


def answer_pairs(cells: DataFrame) -> DataFrame:
    """(file, no, answer): a number cell and the answer cell right of it; / counts as ／."""
    from pyspark.sql import Window

    nxt = F.lead("cell").over(Window.partitionBy("file", "line_no").orderBy("cell_no"))
    pairs = cells.withColumn("answer", F.regexp_replace(nxt, "/", "／")).where(F.col("cell").rlike(r"^\d+$") & F.col("answer").rlike("^[A-E／]+$"))
    return pairs.select("file", F.col("cell").cast("int").alias("no"), "answer")


def valid_pdf(content: Column) -> Column:
    """Magic bytes at the head, the end mark near the tail, and more than a kilobyte."""
    head = F.substring(content, 1, 4) == F.unhex(F.lit("25504446"))
    return head & (F.length(content) > 1024) & F.contains(F.hex(F.substring(content, -32, 32)), F.lit("2525454F46"))


def links(pages: DataFrame, base: str) -> DataFrame:
    """(url, link, name): links of pages' HTML, made absolute; the file name decoded."""
    root = base.split("/", 3)
    host = "/".join(root[:3])
    raw = pages.select("url", F.explode(F.regexp_extract_all("html", F.lit("href=[\"']([^\"']*)[\"']"), 1)).alias("raw"))
    link = F.when(F.col("raw").rlike("^https?://"), F.col("raw")).when(F.col("raw").startswith("/"), F.concat(F.lit(host), "raw")).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), "raw"))
    return raw.select("url", link.alias("link"), F.try_url_decode(F.element_at(F.split("raw", "/"), -1)).alias("name"))


def data_uris(files: DataFrame, names: DataFrame) -> DataFrame:
    """(name, uri) of the named images of a binaryFile table, null where the file is missing."""
    content = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    uri = F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64("content"), "\r\n", ""))
    return names.select("name").distinct().join(content, "name", "left").select("name", uri.alias("uri"))
