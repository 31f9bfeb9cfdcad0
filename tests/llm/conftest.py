import pytest

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.fixture
def folder(spark, tmp_path):
    """Write tables (name=rows) as single Parquet files and give their folder."""

    def make(**tables):
        at = tmp_path / "in"
        for name, rows in tables.items():
            rows = [tuple(r) + (None,) * (len(SCHEMAS[name].split(", ")) - len(r)) for r in rows]
            tmp = tmp_path / f"tmp_{name}"
            spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(str(tmp))
            at.mkdir(exist_ok=True)
            next(tmp.glob("*.parquet")).rename(at / f"{name}.parquet")
        return str(at)

    return make


@pytest.fixture
def odd_documents():
    """Texts that operators must not stumble over: null, empty, blank, very long, repeated, with ties."""
    prose = " ".join(f"word{i % 97} alpha{i % 89}" for i in range(300))
    return [
        (1, None, "en", "b", None),
        (2, "", "en", "b", 0),
        (3, " \n\t \r\n", None, None, 5),
        (4, prose, "en", "a", 10),
        (5, prose, "en", "a", 10),
        (6, prose + " tail", "en", None, 10),
        (7, "x " * 200_000, "en", "a", 10),
        (8, "#### $$ | one\none\none\n" * 30, "en", "a", 10),
        (9, "cc by cc by CC-BY all rights reserved. General  Public\nLicense", "en", "z", 10),
        (10, "Ünïcode 한글 \u00a0nbsp\u2003em 😀 \x1c\x85 <|endoftext|> tail", "en", "z", 10),
        (None, "a row without an id", "en", "z", 10),
        (11, "one two", "en", "b", 10),
        (12, "ONE two", "en", "b", 10),
        (4, prose, "en", "a", 10),
    ]
