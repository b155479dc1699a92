"""The registered queries of the text operators, and their SQL."""

from lidarlattice.llm import byte_bpe, collocations, decontaminate, html_extract, language_id, quality, sentencepiece_codec, sharding, simhash, spelling, toxicity, vectors, warc

MODULES = (decontaminate, html_extract, vectors, sharding, warc, language_id, simhash, quality, toxicity, sentencepiece_codec, collocations, spelling, byte_bpe)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLE_SQL.items()}
