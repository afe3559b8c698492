"""corpusforge: article-corpus preparation as Spark DataFrame jobs.

Layout
------
functions/   Column -> Column building blocks (text rules, sentences, tokens)
operators/   DataFrame -> DataFrame transforms (articles, html, split, stats, lexicon)
sources/     schemas, scans and sinks
streaming/   incremental (Structured Streaming) variants
plans/       composed end-to-end jobs and the query registry
"""

__version__ = "0.1.0"
