"""All test folders are collected together, and the rest without the text operators."""

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)


def collected(folder):
    run = subprocess.run(
        [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=folder, capture_output=True, text=True, timeout=300,
    )
    assert run.returncode == 0, run.stdout[-2000:] + run.stderr[-2000:]
    return [x for x in run.stdout.splitlines() if "::" in x]


def test_all_together():
    found = {x.split("::")[0] for x in collected(ROOT)}
    own = {f for f in os.listdir(HERE) if f.startswith("test_")}
    assert {f"tests/{f}" for f in own} <= found
    if os.path.isdir(f"{HERE}/llm"):
        assert any(x.startswith("tests/llm/") for x in found)


def test_without_the_text_operators(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "rest", ignore=skip)
    found = collected(tmp_path / "rest")
    assert len(found) > 200
    assert not any("op1_" in x or "pipeline" in x for x in found)
