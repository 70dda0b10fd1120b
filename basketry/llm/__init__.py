"""Training-data operators: near and exact dedup, token counts, packing, PII, language ID,
licenses, top-k search, phrases, tokenizer alignment.

One module per operator; ``queries.py`` holds the thin registered queries and
``oracle.py`` their DuckDB SQL. Nothing outside this folder imports it.
"""
