"""basketry: bulk self-checkout analytics on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
to the driver. See README.md for the operator map.
"""

from basketry.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
