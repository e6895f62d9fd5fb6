"""The bench's per-query shuffle attribution from an event log."""

import json

import bench


def _stage(sid, start_ms, written):
    return {"Event": "SparkListenerStageCompleted", "Stage Info": {
        "Stage ID": sid, "Submission Time": start_ms,
        "Accumulables": [{"Name": "internal.metrics.shuffle.write.bytesWritten",
                          "Value": written}]}}


def test_shuffle_bytes_are_attributed_by_time_window(tmp_path):
    log = tmp_path / "app"
    log.mkdir()
    events = [_stage(0, 1_000, 2_000_000), _stage(1, 1_500, 1_000_000), _stage(2, 5_000, 500_000),
              {"Event": "SparkListenerJobStart"}]
    (log / "events").write_text("\n".join(json.dumps(e) for e in events))
    out = bench._io_per_query(str(tmp_path), {"q1": (0.9, 2.0), "q2": (4.9, 6.0), "q3": (7, 8)})
    assert out["shuffle_write"] == {"q1": 3.0, "q2": 0.5, "q3": 0.0}
