"""Column expressions on words and lines that several operators share."""

import string

from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"


def whole(text):
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text):
    """A-Z in lower case; other letters stay."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def digest(*columns):
    """Two 64-bit hashes as one value; nulls are skipped."""
    return F.struct(
        F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit("second"), *columns).alias("h2")
    )


def remainder(doc_id, n):
    """crc32 of the id as text, mod ``n``; a null id counts as an empty text."""
    return F.crc32(whole(F.col(doc_id).cast("string"))) % n


_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def lower_words(text):
    """Words of a text between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode().translate(_LOWER).split()
