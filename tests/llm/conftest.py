import pytest

from llm import data


@pytest.fixture(scope="session")
def odd(tmp_path_factory):
    """Tables of awkward rows, with columns whose names clash with those the operators use."""
    folder = tmp_path_factory.mktemp("odd")
    return data.write(
        folder, documents=data.documents(True), pages=data.pages(True), benchmark=data.benchmark(),
        labels=data.labels())


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    return data.write(
        folder, documents=data.DOCUMENTS.empty_table(), pages=data.PAGES.empty_table(), benchmark=data.ITEMS.empty_table(),
        labels=data.LABELS.empty_table())
