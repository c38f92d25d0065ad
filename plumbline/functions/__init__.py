"""Column expressions: everything here stays inside Catalyst."""

from plumbline.functions.columns import *  # noqa: F401,F403
from plumbline.functions.tails import chi2_upper_tail, kolmogorov_upper_tail  # noqa: F401
