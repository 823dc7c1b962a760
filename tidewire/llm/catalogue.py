"""All queries of this subpackage, by name, with their SQL."""

from tidewire.llm import queries_dedup, queries_pages, queries_text

QUERIES = {**queries_dedup.QUERIES, **queries_pages.QUERIES, **queries_text.QUERIES}
SQL = {**queries_dedup.SQL, **queries_pages.SQL, **queries_text.SQL}
