"""Small tables that hold the awkward cases."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, `row` int, kept boolean, "
    "key string, copy int, copies int, rate double, part int, place int, `index` int, start int, `_key` string, "
    "group_size int, node long, component long, limit double, cost double, perplexity double, matches string, "
    "score string, Found int, ids int, length int, n_tokens string, _leaves long, leaves long, digest_ string, row_number int, n long, kept_row string"
)
_WIDTH = len(SCHEMA.split(", "))


def frame(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) with many further columns, filled with nulls."""
    full = [tuple(row) + (None,) * (_WIDTH - len(row)) for row in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = "lorem ipsum dolor sit amet " * 60_000

EDGES = [
    (1, "alpha beta gamma delta epsilon zeta eta", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (None, "a text without an id", "en", None),
    (4, "same\t\n text", "en", "a"),
    (5, "same text", "de", "b"),
    (5, "same text", "de", "b"),
    (6, " \n\t ", "de", "b"),
    (7, "12345 !!! ???", None, "b"),
    (8, LONG, "en", "a"),
    (9, "übergrößenträger 中文 😀", "de", "b"),
]
