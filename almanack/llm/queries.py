"""The queries of this subpackage, and SQL where SQL can express them."""

from . import embeddings, fingerprints, licenses, lines, mixing, ngrams, packing, quality, substrings, toxicity

_MODULES = (mixing, ngrams, licenses, packing, fingerprints, substrings, embeddings, toxicity, lines, quality)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
