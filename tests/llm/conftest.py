import pytest

from txflow.llm.common import importable


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


LONG = " ".join(f"word{i % 977} thé" for i in range(30_000))
TEXTS = [None, "", " \t\n", "a", "The Mit License and gnu-general public License. CC BY", "x" * 3000,
         "same text here for all of us", "same text here for all of us", "Ünïcödé ΣΑΣ 🙂 <|endoftext|> tail", LONG,
         'token = "abcdef0123456789abcdef01" mail me@x.example.com or 10.0.0.255 +1 (301) 555-0346 4929348385146306']


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like the operators' own."""
    clash = ("id fp root row ids h base spans places words score language lang_pred component_id least node key rule "
             "head part n k vec unit cells copies all_words held blocks").split()
    rows = [(i if i % 5 else None, t, "en" if i % 2 else None, None, None, *[None] * len(clash)) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[6], rows[9], rows[1]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in clash))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def plain(rows):
    """Rows in an order of their own, nulls included."""
    return sorted((tuple(r) for r in rows), key=repr)
