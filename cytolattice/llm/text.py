"""Words of a text, parts of bounded size of a batch of texts, and keys of rows."""

from pyspark.sql import Column, DataFrame, functions as F

SPACES = b" \t\n\x0b\x0c\r"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
TO_LOWER = bytes.maketrans(UPPER, LOWER)


def words_of(text):
    """UTF-8 words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return text.encode().split() if text else []


def lowered_words(text):
    """The same with A-Z in lower case."""
    return text.encode().translate(TO_LOWER).split() if text else []


def slices(texts, chars):
    """(start, stop) of runs of texts of about ``chars`` together; a longer text is a run of its own."""
    start = 0
    while start < len(texts):
        stop, size = start + 1, len(texts[start] or "")
        while stop < len(texts) and size + len(texts[stop] or "") <= chars:
            size += len(texts[stop] or "")
            stop += 1
        yield start, stop
        start = stop


def row_key(df: DataFrame) -> Column:
    """128-bit hash of a whole row: it names the row, or several equal rows together."""
    columns = [F.col(f"`{n}`") for n, kind in df.dtypes if "map<" not in kind and kind not in ("void", "variant")]
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


def small_batches(spark, rows: int = 1000) -> None:
    """Texts are long: batches sent to Python workers hold ``rows`` rows, unless the session says otherwise."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))


def parts(values, rows=500):
    """Consecutive parts of a batch, so that results of one part are sent before the next is made."""
    return (values[i:i + rows] for i in range(0, len(values), rows))
