"""Sitemap documents as rows of URLs, emitted while a document is read.

``location_rows`` gives (url, kind, error, loc_no, loc): one row with loc_no 0 per
document, which says what it is, and one row per URL of a valid one, numbered
from 1 in first-seen order. Values are those of ``parse_sitemaps``; no row holds
all URLs of a document, and no task the inflated bytes of one.

An error late in a document discards all its URLs, so they cannot be emitted
before its end is known. A document is read in chunks (a gzip layer is undone
chunk by chunk) and its first BUFFER URLs are kept: if there are no more, they are
the result. A document with more is read once more, now known to be valid, and its
URLs leave in Arrow batches as they are met. What grows with a document is a
16-byte digest per distinct URL. Text lists are read in the JVM, as before.
"""

from __future__ import annotations

import codecs
import gzip
import hashlib
import io
import zlib
from collections.abc import Callable, Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlmeta.functions.text import JAVA_TRIM_CHARS
from crawlmeta.operators import sitemap_docs as docs_op
from crawlmeta.operators.robots import decode_body
from crawlmeta.operators.sitemap_docs import KIND_FAILED, KIND_INDEX, KIND_URLSET, LocationReader, _refuse, _Unusable, usable_root
from crawlmeta.session import ship_package

#: URLs of a document that are kept while it is read for the first time, and rows of an Arrow batch.
BUFFER, BATCH = 4096, 4096
_CHUNK = 256 << 10
_ROWS = "url string, root string, ns string, problem string, unpacked string, filled boolean, loc_no int, loc string"


class BadGzip(Exception):
    pass


def _chunks(data: bytes) -> Iterator[bytes]:
    if data[:2] != docs_op.GZIP_MAGIC:
        yield from (data[i:i + _CHUNK] for i in range(0, len(data), _CHUNK))
        return
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(data)) as f:
            while part := f.read(_CHUNK):
                yield part
    except (OSError, EOFError, zlib.error) as ex:
        raise BadGzip(str(ex)) from ex


def _parser_input(chunks: Iterator[bytes]) -> tuple[Iterator[bytes], str | None]:
    """What expat is fed, and the encoding to force on it."""
    head = b""
    for part in chunks:
        head += part
        if len(head) >= 1024:
            break
    declared = docs_op._DECLARED.match(head[:1024].removeprefix(codecs.BOM_UTF8))

    def every() -> Iterator[bytes]:
        if head:
            yield head
        yield from chunks

    name = codecs.lookup(declared[1].decode("ascii")).name if declared else "utf-8"
    if name in docs_op._NATIVE:
        return every(), None
    decoder = codecs.getincrementaldecoder(name)()

    def decoded() -> Iterator[bytes]:
        for part in every():
            yield decoder.decode(part).encode("utf-8")
        yield decoder.decode(b"", True).encode("utf-8")

    return decoded(), "utf-8"


class _Handler(LocationReader):
    """Hands each distinct URL on as it is met."""

    def __init__(self, taken: Callable[[str], None]):
        super().__init__()
        self.taken, self.seen = taken, set()

    def take(self, loc: str) -> None:
        if loc := loc.strip(JAVA_TRIM_CHARS):
            digest = hashlib.blake2b(loc.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            if digest not in self.seen:
                self.seen.add(digest)
                self.taken(loc)


def _read(data: bytes, taken: Callable[[str], None]) -> Iterator[tuple[str | None, str, str | None, str | None] | None]:
    """Reads a document; yields None after each chunk, at last (root, namespace, XML problem, gzip problem)."""
    handler = _Handler(taken)
    problem = unpacked = None
    try:
        parts, encoding = _parser_input(_chunks(data))
        parser = expat.ParserCreate(encoding, namespace_separator=" ")
        parser.SetParamEntityParsing(expat.XML_PARAM_ENTITY_PARSING_NEVER)
        parser.StartElementHandler, parser.EndElementHandler = handler.opened, handler.closed
        parser.CharacterDataHandler = handler.characters
        parser.EntityDeclHandler = _refuse
        parser.ExternalEntityRefHandler = lambda *_: 0
        for part in parts:
            parser.Parse(part, False)
            yield None
        parser.Parse(b"", True)
    except _Unusable:
        pass
    except BadGzip as ex:
        unpacked = str(ex)
    except (expat.ExpatError, ValueError, LookupError) as ex:
        problem = str(ex)
        if data[:2] == docs_op.GZIP_MAGIC:  # a broken layer counts before the text that it gave
            try:
                for _ in _chunks(data):
                    pass
            except BadGzip as bad:
                unpacked = str(bad)
    yield handler.root, handler.ns, problem, unpacked


def _document(url: str, data: bytes) -> Iterator[list[tuple]]:
    """Batches of rows of one document."""
    kept: list[str] = []
    count = [0]

    def first(loc: str) -> None:
        count[0] += 1
        if count[0] <= BUFFER:
            kept.append(loc)

    root, ns, problem, unpacked = next(x for x in _read(data, first) if x is not None)
    if root is not None and not usable_root(root, ns) and data[:2] == docs_op.GZIP_MAGIC and unpacked is None:
        try:
            for _ in _chunks(data):
                pass
        except BadGzip as bad:
            unpacked = str(bad)
    yield [(url, root, ns, problem, unpacked, count[0] > 0, 0, None)]
    if problem is not None or unpacked is not None or root is None or not usable_root(root, ns):
        return
    if count[0] <= BUFFER:
        yield [(url, root, ns, None, None, True, i, loc) for i, loc in enumerate(kept, 1)]
        return
    waiting: list[str] = []
    at = 1
    for _ in _read(data, waiting.append):
        while len(waiting) >= BATCH:
            part, waiting[:] = waiting[:BATCH], waiting[BATCH:]
            yield [(url, root, ns, None, None, True, at + i, loc) for i, loc in enumerate(part)]
            at += len(part)
    if waiting:
        yield [(url, root, ns, None, None, True, at + i, loc) for i, loc in enumerate(waiting)]


def _emit(batches):
    """Arrow batches of (url, body) to Arrow batches of rows."""
    import pyarrow as pa
    schema = pa.schema([(n, {"int": pa.int32(), "boolean": pa.bool_()}.get(t, pa.string())) for n, t in (
        c.split(" ") for c in _ROWS.split(", "))])
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
        held.clear()
        return out

    for batch in batches:
        for url, data in zip(batch.column(0), batch.column(1)):
            for rows in _document(url.as_py(), data.as_py()):
                held.extend(rows)
                if len(held) >= BATCH:
                    yield made()
    if held:
        yield made()


@F.pandas_udf(T.BinaryType())
def _unpacked_head(bodies: pd.Series) -> pd.Series:
    def head(data):
        if data is None:
            return None
        try:
            return next(_chunks(data), b"")[:256]
        except BadGzip:
            return None
    return bodies.map(head)


def _is_xml(body: Column) -> Column:
    """Whether a document is read as XML; null for one that cannot be unpacked."""
    zipped = F.substring(body, 1, 2) == F.lit(docs_op.GZIP_MAGIC)
    head = F.when(zipped, _unpacked_head(F.when(zipped, body))).otherwise(F.substring(body, 1, 256))
    return decode_body(head).rlike(docs_op._XML_HEAD)


def _lists(df: DataFrame) -> DataFrame:
    """url, doc of documents that are not XML; one Python step, for gzip layers only."""
    zipped = F.substring("body", 1, 2) == F.lit(docs_op.GZIP_MAGIC)
    x = df.withColumn("unzipped", docs_op._gunzip(F.when(zipped, F.col("body"))))
    x = x.withColumn("data", F.when(zipped, F.col("unzipped")["data"]).otherwise(F.col("body")))
    doc = (F.when(F.col("body").isNull(), docs_op._result(KIND_FAILED, error=F.lit(docs_op.ERR_NO_DOCUMENT)))
           .when(F.col("data").isNull(), docs_op._result(KIND_FAILED, error=docs_op._error(docs_op.ERR_GZIP, F.col("unzipped")["problem"])))
           .otherwise(docs_op.text_result(F.col("data"))))
    return x.select("url", doc.alias("doc"))


def location_rows(df: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """(url, kind, error, loc_no, loc) of the documents of ``df``."""
    ship_package(df.sparkSession)
    every = df.select(F.col(url).alias("url"), F.col(body).cast("binary").alias("body"))
    every = every.withColumn("xml", F.coalesce(_is_xml(F.col("body")), F.lit(False)))
    read = every.where("xml").select("url", "body").mapInArrow(_emit, _ROWS)
    found = F.struct("root", "ns", F.when(F.col("filled"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")).alias("locs"), "problem")
    status = F.when(F.col("unpacked").isNotNull(), docs_op._result(KIND_FAILED, error=docs_op._error(docs_op.ERR_GZIP, F.col("unpacked")))).otherwise(
        docs_op.xml_result(found))
    kind = F.when(F.col("loc_no") == 0, F.col("status.kind")).when(F.col("root") == KIND_INDEX, KIND_INDEX).otherwise(KIND_URLSET)
    from_xml = read.withColumn("status", F.when(F.col("loc_no") == 0, status)).select(
        "url", kind.alias("kind"), F.col("status.error").alias("error"), "loc_no", "loc")
    lists = _lists(every.where("NOT xml").select("url", "body"))
    numbered = F.concat(F.array(F.struct(F.lit(0).alias("loc_no"), F.lit(None).cast("string").alias("loc"))), F.coalesce(
        F.transform("doc.locs", lambda x, i: F.struct((i + 1).alias("loc_no"), x.alias("loc"))),
        F.array().cast("array<struct<loc_no: int, loc: string>>")))
    from_text = lists.select("url", F.col("doc.kind").alias("kind"), F.col("doc.error").alias("error"), F.inline(numbered))
    return from_xml.unionByName(from_text.withColumn("error", F.when(F.col("loc_no") == 0, F.col("error"))))
