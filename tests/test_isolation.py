import ast
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def sources():
    for folder, _, names in os.walk(os.path.join(ROOT, "orthoskein")):
        if os.path.basename(folder) != "llm":
            yield from (os.path.join(folder, n) for n in names if n.endswith(".py"))


@pytest.mark.parametrize("path", sorted(sources()))
def test_nothing_imports_the_llm_package(path):
    for node in ast.walk(ast.parse(open(path, encoding="utf-8").read())):
        names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or "", *(a.name for a in node.names)] if isinstance(node, ast.ImportFrom) else []
        assert not any("llm" in n.split(".") for n in names)


def test_every_sql_has_its_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
