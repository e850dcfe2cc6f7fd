"""Text expressions with the semantics of Python's str methods, as Column -> Column functions.

Java's classes differ from Python's: white space here also holds U+001C to
U+001F, lines end at every boundary that str.splitlines knows, and `(?U)`
makes \\d, \\s and \\b follow Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
#: The characters of SPACE, one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MARK = r"[^\s\x1c-\x1f]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.btrim(col(x), F.lit(SPACES))


def lines(x: Column | str) -> Column:
    """Lines of a text; a final line end leaves an empty last line, unlike splitlines."""
    return F.split(col(x), LINE_END)


def words(x: Column | str) -> Column:
    return F.filter(F.split(col(x), rf"(?U){SPACE}+"), lambda w: w != "")


def word_count(x: Column | str) -> Column:
    return F.size(words(x))


def collapse(x: Column | str) -> Column:
    """Words joined by one space."""
    return F.array_join(words(x), " ")


def alnum_ratio(x: Column | str) -> Column:
    """Letters and digits over characters that are not space; 0 without any."""
    solid = F.regexp_replace(col(x), rf"(?U){SPACE}+", "")
    kept = F.length(F.regexp_replace(solid, r"[^\p{L}\p{N}]", ""))
    return F.when(F.length(solid) == 0, F.lit(0.0)).otherwise(kept / F.length(solid))


def fixed(x: Column | str, places: int) -> Column:
    """A double with so many places, rounded half to even by the binary value itself, as C and Python print it.

    The scaled value can lie on a tie only if its rounded product does; there the product's error, which is exact
    for a factor of few bits, tells on which side the value is.  From 2^52 / 10^places on there is nothing to round
    but by Java's own format.
    """
    factor = float(10**places)

    def one(v: Column) -> Column:  # within a lambda, so that the value is computed once and the code stays small
        size = F.abs(v)
        product = size * factor
        below = F.floor(product)
        tie = (product - below) == 0.5
        high = size * 134217729.0 - (size * 134217729.0 - size)
        error = (high * factor - product) + (size - high) * factor
        up = (tie & (error > 0)) | (tie & (error == 0) & (below % 2 == 1)) | ((product - below) > 0.5)
        whole = (below + up.cast("long")).cast("string")
        digits = F.lpad(whole, F.greatest(F.length(whole), F.lit(places + 1)), F.lit("0"))
        text = F.concat(F.substring(digits, F.lit(1), F.length(digits) - places), F.lit("."), F.substring(digits, F.length(digits) - places + 1, F.lit(places))) if places else whole
        sign = F.when(v.cast("string").startswith("-"), "-").otherwise("")
        return F.when(F.isnan(v), "nan").when(size == float("inf"), F.concat(sign, F.lit("inf"))).when(product < float(1 << 52), F.concat(sign, text)).otherwise(F.format_string(f"%.{places}f", v))

    return F.get(F.transform(F.array(col(x).cast("double")), one), F.lit(0))
