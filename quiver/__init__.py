"""quiver: follower-graph analytics on Spark DataFrames.

Edges are ``(follower BIGINT, followee BIGINT)`` DataFrames (a bag). Sources
live in :mod:`quiver.sources`, operators in :mod:`quiver.operators`, column
helpers in :mod:`quiver.functions`, result writers in :mod:`quiver.sinks`,
the query registry in :mod:`quiver.plans` and the incremental form in
:mod:`quiver.streaming`.
"""

from quiver.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
