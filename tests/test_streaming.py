"""Incremental ingestion: each landed file is normalised exactly once, like the batch path."""

import json
import os

from matchday.operators.normalize import normalize
from matchday.sources.feed import read_feed, scan_records
from matchday.streaming import normalize_stream
from test_normalize import FINAL, HALF, _match


def _land(d, name, matches):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        json.dump(matches, f)


def test_stream_matches_batch_and_resumes(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    out_root = os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    _land(landing, "bl1_2023.json", [_match(1, [FINAL, HALF]), _match(2, [])])

    q = normalize_stream(spark, landing, out_root, checkpoint=ckpt)
    q.awaitTermination(120)
    first = scan_records(spark, out_root, "matchResults")
    want = normalize(read_feed(spark, landing))
    assert sorted(map(tuple, first.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)

    # a new season lands; the restarted query reads only the new file
    _land(landing, "bl2_2023.json", [_match(3, [FINAL], leagueShortcut="bl2")])
    q = normalize_stream(spark, landing, out_root, checkpoint=ckpt)
    q.awaitTermination(120)
    back = scan_records(spark, out_root, "matchResults")
    assert back.count() == 4
    assert sorted(r[0] for r in back.select("matchID").collect()) == [1, 1, 2, 3]


def test_default_checkpoint_survives_a_new_session_folder_and_batch_rows_stay(spark, tmp_dir):
    """The default checkpoint follows from the folders, not from the session; batch and stream share a root."""
    from matchday.plans import normalize_seasons

    landing, feed, out_root = (os.path.join(tmp_dir, x) for x in ("landing", "feed", "out"))
    os.makedirs(landing)
    os.makedirs(feed)
    _land(landing, "bl1_2023.json", [_match(1, [FINAL])])
    normalize_stream(spark, landing, out_root).awaitTermination(120)

    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(os.path.join(tmp_dir, "another session"))
    try:
        _land(landing, "bl2_2023.json", [_match(2, [FINAL], leagueShortcut="bl2")])
        normalize_stream(spark, landing, out_root).awaitTermination(120)
    finally:
        spark.sparkContext.setCheckpointDir(before)
    assert sorted(r[0] for r in scan_records(spark, out_root).select("matchID").collect()) == [1, 2]

    _land(feed, "bl3_2023.json", [_match(3, [FINAL], leagueShortcut="bl3")])
    _land(feed, "bl2_2023.json", [_match(4, [FINAL], leagueShortcut="bl2")])
    normalize_seasons(spark, feed, out_root)
    # the season that was written in batch replaces its streamed rows, the others stay
    assert sorted(r[0] for r in scan_records(spark, out_root).select("matchID").collect()) == [1, 3, 4]


def test_two_landing_folders_do_not_share_progress(spark, tmp_dir):
    out_root = os.path.join(tmp_dir, "out")
    for i, name in enumerate(("a", "b")):
        landing = os.path.join(tmp_dir, name)
        os.makedirs(landing)
        _land(landing, f"bl{i}_2023.json", [_match(i, [FINAL], leagueShortcut=f"bl{i}")])
        normalize_stream(spark, landing, out_root).awaitTermination(120)
    assert sorted(r[0] for r in scan_records(spark, out_root).select("matchID").collect()) == [0, 1]
