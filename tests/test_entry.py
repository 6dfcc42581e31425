"""The optional part is left out only where its files are missing."""

from __future__ import annotations

import sys

import pytest

import __spark_entry__


def test_missing_files_are_told_from_broken_ones(tmp_path, monkeypatch):
    there = __spark_entry__._is_there
    assert there("ledgerlane.queries")
    assert not there("ledgerlane.no_such_folder.queries") and not there("ledgerlane.no_such_file")
    assert not there("no_such_module_anywhere")
    package = tmp_path / "broken_package"
    package.mkdir()
    (package / "__init__.py").write_text("import no_such_module_anywhere\n")
    (package / "queries.py").write_text("")
    monkeypatch.syspath_prepend(tmp_path)
    with pytest.raises(ModuleNotFoundError, match="no_such_module_anywhere"):
        there("broken_package.queries")
    sys.modules.pop("broken_package", None)
