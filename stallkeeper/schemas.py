"""Explicit schemas of every table the jobs read or write."""

from pyspark.sql import types as T

CRAWL = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("fetch_time", T.LongType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)

INDEX_HIT = T.StructType(
    [
        T.StructField(
            "_source",
            T.StructType(
                [
                    T.StructField(name, T.StringType())
                    for name in ("url", "title", "text", "domain", "retrieved")
                ]
            ),
        )
    ]
)

# One tag of the page head: the attributes the meta-tag extractors look at.
META_TAG = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("name", "property", "content", "price", "currency", "category")
    ]
)

# What one pass over the HTML yields; nothing here is interpreted yet.
PARSED = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("jsonld", T.ArrayType(T.StringType())),
        T.StructField("microdata", T.ArrayType(T.StringType())),
        T.StructField("metas", T.ArrayType(META_TAG)),
        T.StructField("seller", T.StringType()),
        T.StructField("seller_info", T.ArrayType(T.StringType())),
        T.StructField("seller_url", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("frame_src", T.StringType()),
    ]
)

# The fields an extraction source may fill, in output order.
CANDIDATE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("production_data", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("seller", T.StringType()),
        T.StructField("seller_type", T.StringType()),
        T.StructField("seller_url", T.StringType()),
        T.StructField("seller_info", T.ArrayType(T.StringType())),
        T.StructField("location", T.StringType()),
    ]
)

# Columns merged per (snapshot, url); the first non-null value in page order wins.
MERGED = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("retrieved", T.StringType()),
        T.StructField("production_data", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("seller", T.StringType()),
        T.StructField("seller_type", T.StringType()),
        T.StructField("seller_url", T.StringType()),
        T.StructField("seller_info", T.ArrayType(T.StringType())),
        T.StructField("location", T.StringType()),
        T.StructField("ships to", T.StringType()),
    ]
)

LISTINGS = T.StructType(
    [
        T.StructField("snapshot", T.StringType()),
        T.StructField("url", T.StringType()),
        *MERGED.fields,
        T.StructField("retrieved_ts", T.TimestampType()),
        T.StructField("id", T.StringType()),
        T.StructField("loc_name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)

GAZETTEER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)

DOMAIN_RULES = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("pattern", T.StringType()),
    ]
)

# The history of texts: where a text was seen first, a filter for each bucket, and generations that were
# put together.
SEEN = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("page_order", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("generation", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
# The same for addresses: which runs have evidence of one.
ADDRESSES = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("generation", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
FILTERS = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("keys", T.LongType()),
        T.StructField("generation", T.StringType()),
    ]
)
REPLACED = T.StructType(
    [
        T.StructField("old", T.StringType()),
        T.StructField("new", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

# The inverted index: where a word stands in a document, and how much a generation holds.
POSTINGS = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
        T.StructField("length", T.IntegerType()),
        T.StructField("generation", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
TOTALS = T.StructType(
    [
        T.StructField("documents", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField("generation", T.StringType()),
    ]
)

# Pages that lost their place to one with the same text and an earlier file name.
DISPLACED = T.StructType(
    [
        T.StructField("snapshot", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("page_order", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("snapshot", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("enriched", T.BooleanType()),
        T.StructField("run_id", T.StringType()),
        # Place in the order of commits, and the columns a run has stored beyond the usual ones.
        T.StructField("seq", T.LongType()),
        T.StructField("extra", T.StringType()),
    ]
)

# What every page of a run says about its address, merged over runs.
EVIDENCE = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("page_order", T.LongType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("url", T.StringType()),
        *MERGED.fields,
        T.StructField("has_text", T.BooleanType()),
        T.StructField("run_id", T.StringType()),
    ]
)

FAILED = T.StructType(
    [
        T.StructField("snapshot", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("snapshot", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

COUNTERS = T.StructType(
    [
        T.StructField("snapshot", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("received", T.LongType()),
        T.StructField("kept", T.LongType()),
        T.StructField("malformed", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)
