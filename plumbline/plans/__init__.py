"""Named queries over the test tables, each with its SQL twin where one exists."""

from plumbline.plans.catalogue import ORACLES, QUERIES, load_all  # noqa: F401
