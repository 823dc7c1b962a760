"""All queries outside the subpackage llm, by name, with their SQL."""

from tidewire.plans import domain, problems, runs, texts

FLAGSHIP = "p4_hourly_figures"
QUERIES = {**texts.QUERIES, **domain.QUERIES, **runs.QUERIES, **problems.QUERIES}
SQL = {**texts.SQL, **domain.SQL, **runs.SQL, **problems.SQL}
