"""Text expressions: whitespace, tokens, sentences, windows.

Everything here is a Column built from JVM functions, so it stays inside the
scan stage of whatever plan uses it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode text processing treats as white space,
# the four ASCII separators 1C to 1F included.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set for patterns; the class test is far cheaper than a list of ranges.
WS = "[\\x1c-\\x1f\\p{IsWhite_Space}]"

TOKEN_MODES = ("ws", "word", "ascii")


def strip(text: Column) -> Column:
    """Drop leading and trailing white space of every kind, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """Words between runs of white space, in order."""
    return F.array_remove(F.split(text, WS + "+"), "")


def flatten_whitespace(text: Column) -> Column:
    """Every run of white space becomes one blank; ends are trimmed."""
    return strip(F.regexp_replace(text, WS + "+", " "))


def tidy_paragraphs(text: Column) -> Column:
    """Unify line ends, squeeze blanks, keep at most one empty line in a row."""
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    blanks = F.regexp_replace(unix, "[ \\t]+", " ")
    return strip(F.regexp_replace(blanks, "\\n{3,}", "\n\n"))


def tokens(text: Column, mode: str = "word") -> Column:
    """Lower-cased tokens: ``ws`` by white space, ``word`` as runs of letters,
    digits and underscores, ``ascii`` as those runs that are plain a-z and 0-9."""
    if mode not in TOKEN_MODES:
        raise ValueError(f"mode must be one of {TOKEN_MODES}, not {mode!r}")
    lowered = F.lower(text)
    if mode == "ws":
        return words(lowered)
    found = F.regexp_extract_all(lowered, F.lit("[a-z0-9_\\p{L}\\p{N}]+"), F.lit(0))
    if mode == "word":
        return found
    return F.filter(found, lambda t: t.rlike("^[a-z0-9]+$"))


def sentence_array(text: Column) -> Column:
    """Sentences ended by ``.``, ``!`` or ``?``, stripped, blanks dropped."""
    parts = F.split(text, "(?<=[.!?])" + WS + "+")
    return F.array_remove(F.transform(parts, strip), "")


def paragraph_array(text: Column, sep: str = "\n\n") -> Column:
    """Pieces between ``sep``, stripped, blanks dropped."""
    parts = F.split(text, "\\Q" + sep + "\\E")
    return F.array_remove(F.transform(parts, strip), "")


def word_windows(paragraphs: Column, size: int, overlap: int) -> Column:
    """Each paragraph whole if it has at most ``size`` words, otherwise windows
    of ``size`` words that share ``overlap`` with the one before."""
    _check_window(size, overlap)
    step = size - overlap
    # The words are computed once per paragraph and bound to the lambda
    # variable; every window is then a slice of that array.
    split_once = F.transform(paragraphs, lambda p: F.struct(p.alias("p"), words(p).alias("w")))

    def cut(x: Column) -> Column:
        n = F.size(x["w"])
        last = F.ceil((n - size) / F.lit(step)).cast("int")
        return F.when(n <= size, F.array(x["p"])).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.array_join(F.slice(x["w"], i * step + 1, F.lit(size)), " "),
            )
        )

    return F.flatten(F.transform(split_once, cut))


def char_windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters that share ``overlap`` with the one
    before, each stripped, blank ones dropped.

    The text is cut once into pieces of one step; a window is the next few
    pieces put together. That is linear in the text, where a substring per
    window would walk a long text from its start every time.
    """
    _check_window(size, overlap)
    step = size - overlap
    per_window = -(-size // step)
    piece = F.lit("(?s).{1,%d}" % step)
    bound = F.transform(
        F.array(text),
        lambda t: F.struct(
            F.regexp_extract_all(t, piece, F.lit(0)).alias("s"), F.char_length(t).alias("n")
        ),
    )

    def cut(x: Column) -> Column:
        last = F.greatest(F.ceil((x["n"] - size) / F.lit(step)).cast("int"), F.lit(0))
        return F.when(x["n"] <= 0, F.array().cast("array<string>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: strip(
                    F.substring(F.array_join(F.slice(x["s"], i + 1, F.lit(per_window)), ""), 1, size)
                ),
            )
        )

    return F.array_remove(F.flatten(F.transform(bound, cut)), "")


def _check_window(size: int, overlap: int) -> None:
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError(f"need 0 <= overlap < size, got size={size} overlap={overlap}")
