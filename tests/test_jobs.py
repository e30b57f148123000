"""The jobs, end to end: publish, score as a stream, report; train a classifier."""

import json

import pytest

from valence.jobs import preview_corpus, publish_messages, report, stream_scores, train_classifier
from valence.operators import classifier, latest


def test_publish_score_report(spark, tmp_path, capsys):
    (tmp_path / "lines.txt").write_text("# note\nI feel terrible\nnot bad\n", encoding="utf-8")
    inbox, out = str(tmp_path / "in"), str(tmp_path / "scored")
    publish_messages.main(["--lines", str(tmp_path / "lines.txt"), "--sink", "json", "--out", inbox])
    stream_scores.main(
        ["--source", "json", "--path", inbox, "--sink", "parquet", "--sink", "console", "--out", out, "--once",
         "--checkpoint", str(tmp_path / "c")]
    )
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == [f"msg_{i:05d}" for i in range(1, 17 + 14 + 2 + 1)]
    payload = json.loads(report.main(["--scored", out, "--rows", "5"]))
    assert payload["total"] == 33 and payload["positive"] + payload["negative"] + payload["neutral"] == 33
    assert payload["top_keywords"][0][1] >= payload["top_keywords"][-1][1]


def test_train_and_preview(spark, tmp_path):
    lines = []
    for i in range(300):
        good = i % 2 == 0
        lines.append(f'"{4 if good else 0}","{i}","d","NO_QUERY","u","{"a lovely sunny day" if good else "some grim rainy night"} {i}"')
    (tmp_path / "c.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    corpus, model = str(tmp_path / "c.csv"), str(tmp_path / "model")
    assert preview_corpus.main(["--corpus", corpus, "--rows", "2"]) == 300
    work = str(tmp_path / "work")
    assert train_classifier.main(["--corpus", corpus, "--model", model, "--rows", "200", "--work", work]) > 0.95
    assert len(classifier.load(model).stages) == 5


def messages(folder, name, ids):
    folder.mkdir(exist_ok=True)
    rows = [json.dumps({"id": i, "text": "good", "source": "s", "user": "u", "timestamp": "noon"}) for i in ids]
    (folder / name).write_text("\n".join(rows) + "\n", encoding="utf-8")


def test_runs_into_one_folder_keep_every_row_once(spark, tmp_path):
    out = str(tmp_path / "scored")
    run = lambda inbox, checkpoint: stream_scores.main(
        ["--source", "json", "--path", str(inbox), "--sink", "parquet", "--out", out, "--once", "--checkpoint", str(tmp_path / checkpoint)]
    )
    messages(tmp_path / "a", "0.json", "abcde")
    run(tmp_path / "a", "c1")
    messages(tmp_path / "a", "1.json", "fg")
    run(tmp_path / "a", "c1")
    messages(tmp_path / "b", "0.json", "xyz")
    run(tmp_path / "b", "c2")
    run(tmp_path / "a", "c1")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list("abcdefgxyz")


def test_rows_without_a_time_reach_the_report(spark, tmp_path):
    messages(tmp_path / "in", "0.json", "abcd")
    out = str(tmp_path / "scored")
    stream_scores.main(["--source", "json", "--path", str(tmp_path / "in"), "--sink", "parquet", "--out", out, "--once", "--checkpoint", str(tmp_path / "c")])
    scored = spark.read.parquet(out)
    shown = latest.feed_view(latest.latest(scored, 3, "event_ts", "id", arrival="processed_at")).collect()
    assert [(r.id, r.time) for r in shown] == [("d", "00:00:00"), ("c", "00:00:00"), ("b", "00:00:00")]


def test_arguments_are_checked():
    for bad in (["--source", "json"], ["--sink", "parquet"], ["--source", "ftp"], [], ["--once", "--sink", "kafka"]):
        with pytest.raises(SystemExit):
            stream_scores.arguments(bad)
    assert stream_scores.arguments(["--once"]).sink == ["console"]
    given = stream_scores.arguments(["--checkpoint", "c", "--starting-offsets", "earliest", "--fail-on-data-loss", "--max-offsets-per-trigger", "9", "--min-partitions", "4"])
    assert stream_scores.source_options(given) == {
        "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "9", "minPartitions": "4"
    }
    files = stream_scores.arguments(["--source", "json", "--path", "p", "--checkpoint", "c", "--max-files-per-trigger", "5"])
    assert stream_scores.source_options(files) == {"maxFilesPerTrigger": "5"}
