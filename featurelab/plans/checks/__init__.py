"""Check queries over the test tables, each beside the SQL that must give the same rows.

Every module fills QUERIES (name -> function of session and folder) and SQL (name -> text);
queries without SQL are iterative and are tested on fixtures instead.
"""

from featurelab.plans.checks import fitted, learned, outputs, relational, statistics

MODULES = (relational, statistics, fitted, outputs, learned)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in MODULES for name, text in module.SQL.items()}

__all__ = ["QUERIES", "SQL"]
