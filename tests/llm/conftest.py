import pytest

from lexiloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "llm-tests")
    yield session


@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    from lexiloom.llm.words import tokenizer_path

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
