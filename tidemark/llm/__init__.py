"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

from tidemark.llm.oracles import ORACLES as LLM_ORACLES
from tidemark.llm.queries import QUERIES as LLM_QUERIES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
