"""Column -> Column functions (cleaning P1–P21) and row rules."""

from dwspark.functions.clean import *  # noqa: F401,F403
from dwspark.functions.rules import *  # noqa: F401,F403
