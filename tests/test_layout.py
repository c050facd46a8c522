"""What the library's own modules must not do."""

from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
OWN = [p for folder in ("stridebase", "oracle") for p in (ROOT / folder).rglob("*.py") if "llm" not in p.parts]


def test_nothing_imports_the_data_preparation_package():
    assert len(OWN) > 20
    for path in [*OWN, ROOT / "bench.py"]:
        assert "llm" not in path.read_text(), path


def test_no_machine_local_checkpoints():
    for path in (ROOT / "stridebase").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and ".persist(" not in text and ".cache(" not in text, path
