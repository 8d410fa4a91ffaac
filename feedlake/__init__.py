"""feedlake: set-at-a-time Spark jobs that turn landed news feeds into an analysed archive.

Layout:
  functions/  pure Column expressions (text, dates, markup, vectors)
  sources/    table adapters, feed payload parsing, page text, artifact listing
  operators/  keyed table maintenance, selection, similarity, mentions, insight
  sinks/      markdown / feed JSON / JSON-LD / sitemap exports and run metrics
  plans/      end-to-end batch jobs (brief batch, home feed, archive insight)
  streaming/  Structured Streaming forms of ingest, first-seen dedup and mention counts
"""

from feedlake.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
