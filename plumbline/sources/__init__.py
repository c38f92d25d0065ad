"""Readers and writers of feature tables and audit tables."""

from plumbline.sources.tables import *  # noqa: F401,F403
