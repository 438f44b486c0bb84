"""crawlmeta: crawl-metadata analytics as Spark DataFrame transforms.

Layout:
  functions/  Column helpers (text, URL, host, hashing, fetch policy)
  operators/  DataFrame -> DataFrame transforms (robots parse, geo classify,
              sitemap documents, sitemap-index crawl, metrics)
  sources/    readers (manifest, WARC data source, local robots tree, TSV,
              suffix dimension, fetch) and corpora derived from given tables
  sinks/      writers (TSV parts, grouped country / language-region tables,
              robots payload table, Kafka JSON payload)
  plans/      the batch jobs (one function per job mode)
  streaming/  Structured Streaming twins of the stateless jobs
"""

__version__ = "0.1.0"
