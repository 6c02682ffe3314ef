"""Operators for the training-data problems of TESTDATA.md. Nothing else in the library imports this package."""


def queries():
    from corpusmill.llm.problems import QUERIES

    return dict(QUERIES)


def oracle_sql():
    from corpusmill.llm.problems import SQL

    return dict(SQL)
