"""Connected components for the near-duplicate operators."""

from brookflow.operators.components import components  # noqa: F401
