import ast
import os

import __spark_entry__ as entry
from sparkloom.plans import registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_has_rows(spark, data):
    df = entry.entry(spark)
    assert df.count() > 0 and "adj_pval" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())


def test_nothing_else_imports_the_text_operators():
    for folder, _, files in os.walk(os.path.join(ROOT, "sparkloom")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                for node in ast.walk(ast.parse(open(os.path.join(folder, f)).read())):
                    names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                    assert not any(n.startswith("sparkloom.llm") or n == "corpus_pipeline" for n in names), (folder, f)
