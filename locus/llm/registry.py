"""The corpus queries and their SQL."""

from . import boosting, conversations, licenses, media, mixing, periodic, pieces, quality, simhash, suffixes, token_counts, urls, warc

MODULES = (simhash, urls, pieces, warc, licenses, media, quality, token_counts, mixing, suffixes, periodic, conversations, boosting)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
