"""Operators of a training-data pipeline; nothing outside this subpackage imports it."""

from plumbline.llm.catalogue import ORACLES, QUERIES, load_all  # noqa: F401
