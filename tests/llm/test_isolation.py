import ast
from pathlib import Path

import corpusmill


def imported(path):
    """All names that a module imports, as full dotted names."""
    for node in ast.walk(ast.parse(path.read_text())):
        if isinstance(node, ast.Import):
            yield from (a.name for a in node.names)
        elif isinstance(node, ast.ImportFrom):
            yield from (f"{'.' * node.level}{node.module or ''}.{a.name}" for a in node.names)


def test_nothing_else_imports_llm():
    root = Path(corpusmill.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not any("llm" in name.split(".") for name in imported(p)), p
            assert "corpusmill.llm" not in p.read_text(), p
