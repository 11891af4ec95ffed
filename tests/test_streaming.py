"""The streaming follower count agrees with the batch one."""

from quiver import operators as ops
from quiver.sources import read_edges
from quiver.streaming import start_follower_count


def test_stream_matches_batch(spark, tmp_path):
    edge_dir = tmp_path / "edges"
    edge_dir.mkdir()
    (edge_dir / "part-1.txt").write_text("1,2\n3,2\nbad\n2,3\n")
    out = str(tmp_path / "out")

    query = start_follower_count(
        spark, str(edge_dir), out, checkpoint_location=str(tmp_path / "ckpt"), available_now=True
    )
    query.awaitTermination(120)
    first = {r.user: r.followers for r in spark.read.parquet(out).collect()}
    assert first == {2: 2, 3: 1}

    # New files are picked up by a restarted query from the same checkpoint.
    (edge_dir / "part-2.txt").write_text("4,2\n2,1\n")
    query = start_follower_count(
        spark, str(edge_dir), out, checkpoint_location=str(tmp_path / "ckpt"), available_now=True
    )
    query.awaitTermination(120)
    second = {r.user: r.followers for r in spark.read.parquet(out).collect()}
    batch = {r.user: r.followers for r in ops.follower_count(read_edges(spark, str(edge_dir))).collect()}
    assert second == batch == {2: 3, 3: 1, 1: 1}
