from . import corpus, formats, queries, records, silver  # noqa: F401
