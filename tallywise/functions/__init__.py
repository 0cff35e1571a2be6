"""Column -> Column helpers. All are native Spark expressions (no Python UDF)."""

from tallywise.functions.text import *  # noqa: F401,F403
from tallywise.functions.numbers import *  # noqa: F401,F403
from tallywise.functions.dates import *  # noqa: F401,F403
from tallywise.functions.arrays import *  # noqa: F401,F403
