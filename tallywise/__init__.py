"""tallywise: order and stock reconciliation as Spark DataFrame jobs.

Subpackages
-----------
functions  column-level helpers (text, numbers, dates, pairs, arrays)
sources    table loading, landing-file readers, rejects, fixture views, sinks, versions
operators  reusable DataFrame operators (joins with hot keys, null-safe compare join,
           prefix join, first-per-group, last-wins, semi join)
plans      the four user tasks (orders, stock, pull sheet, import candidates,
           storefront inventory) built from the operators
"""

from tallywise.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
