"""Registered queries and their SQL."""

from corvidex.plans import corpus, dialogue, measures, retrieval

QUERIES = {**retrieval.QUERIES, **corpus.QUERIES, **dialogue.QUERIES, **measures.QUERIES}
SQL = {**retrieval.SQL, **corpus.SQL, **dialogue.SQL, **measures.SQL}
