"""The command line, from files to a result."""

import json

import pytest

from docloom import cli


def test_build_and_query_by_settings(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "guide.md").write_text("# 1 Reset Sequence\n\nThe unit shall stop. See Section 2.\n\n# 2 Power States\n\nAfter the Reset Sequence the unit may sleep.\n")
    told = tmp_path / "settings.json"
    told.write_text(json.dumps({"source": "docs", "target": "out/kb", "chunk_files": True}))
    settings = cli.settings_from(str(told))
    assert (settings.source, settings.target) == (str(docs), str(tmp_path / "out/kb"))
    assert cli.resolved("/a/b", "/c") == "/a/b" and cli.resolved("s3://a/b", "/c") == "s3://a/b" and cli.resolved("b", "/c") == "/c/b"
    assert cli.main(["--settings", str(told), "build"]) == 0
    manifest = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert manifest["n_chunks"] == 2 and manifest["xref_edges"] == 1
    assert len(list((tmp_path / "out/kb/chunks").rglob("*.md"))) == 2
    assert cli.main(["query", "reset sequence", "--db", str(tmp_path / "out/kb"), "--k", "2"]) == 0
    lines = capsys.readouterr().out
    assert "Reset Sequence" in lines and "local_search" in lines
    assert cli.main(["doctor", "--db", str(tmp_path / "out/kb")]) == 0
    assert cli.main(["doctor", "--db", str(tmp_path / "nowhere")]) == 1
    assert cli.main(["chunk", str(docs), str(tmp_path / "chunks")]) == 0
    assert spark.read.parquet(str(tmp_path / "chunks")).count() == 2


def test_what_is_missing_is_said(spark, tmp_path):
    with pytest.raises(SystemExit):
        cli.main(["build"])
    bad = tmp_path / "bad.json"
    bad.write_text('{"nonsense": 1}')
    with pytest.raises(ValueError, match="nonsense"):
        cli.settings_from(str(bad))
