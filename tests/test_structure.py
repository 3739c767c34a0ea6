import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_the_library_stands_without_the_training_data_part():
    code = (
        "import pkgutil, importlib, sys, tidemark\n"
        "for m in pkgutil.walk_packages(tidemark.__path__, 'tidemark.'):\n"
        "    if not m.name.startswith('tidemark.llm'):\n"
        "        importlib.import_module(m.name)\n"
        "assert not [m for m in sys.modules if m.startswith('tidemark.llm.')]\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_no_forbidden_ways():
    text = "".join(p.read_text() for p in [*ROOT.glob("tidemark/**/*.py"), *ROOT.glob("*.py")])
    for word in ("localCheckpoint", "crossJoin", ".rdd", "mapPartitions"):
        assert word not in text
