import os
import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {root!r})
from skein.session import local_session
from skein.operators.articles import extract_articles
spark = local_session(2, memory="1g")
pages = spark.createDataFrame([("u", "<article><h1>T</h1><p>x</p></article>")] * 40, "url string, html string").repartition(2)
rows = extract_articles(pages, {{"title": "h1", "paragraphs": "p"}}).collect()
assert len(rows) == 40 and rows[0].title == "T" and rows[0].text == ["", "x"]
# The workers themselves do not find the package.
found = spark.range(1).mapInArrow(lambda batches: (__import__("importlib.util").util.find_spec("skein") and 1 / 0 or b for b in batches), "id long")
assert found.count() == 1
print("shipped")
"""


def test_python_jobs_run_from_another_folder(tmp_path):
    """The driver finds the package by its path; workers start elsewhere and get the functions with the job."""
    root = str(Path(__file__).resolve().parent.parent)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "shipped" in done.stdout, done.stderr[-2000:]
