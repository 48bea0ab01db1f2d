"""The expected SQL is evidence only as far as it is written apart from what it checks."""

from __future__ import annotations

import ast
from pathlib import Path

import oracles
from shelfwise.operators.quality import contract_size
from shelfwise.plans.contract import full_contract


def test_oracles_import_nothing_from_the_package():
    tree = ast.parse(Path(oracles.__file__).read_text())
    names = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)]
    names += [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
    assert not [name for name in names if name.split(".")[0] == "shelfwise"]


def test_both_sides_declare_as_many_checks():
    assert oracles.contract_sql().count(" as check_name") == contract_size(full_contract()) == 119
