"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters on which Python's str.split() separates words.
WHITESPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
FRAME_PREFIX = "^data: "
UNKNOWN_SOURCE = "Documento desconocido"


def words(text: Column) -> Column:
    """Array of whitespace-separated words; runs collapse and an empty text has none."""
    return F.array_remove(F.split(text, WHITESPACE), "")


def word_count(text: Column) -> Column:
    return F.array_size(words(text))


def text_statistics(text: Column) -> Column:
    """The sentence the statistics tool answers with."""
    return F.concat(
        F.lit("El fragmento tiene "),
        word_count(text).cast("string"),
        F.lit(" palabras y "),
        F.length(text).cast("string"),
        F.lit(" caracteres (incluyendo espacios)."),
    )


def strip_frame(value: Column) -> Column:
    """Remove the server-sent-event prefix, if the line has one."""
    return F.regexp_replace(value, FRAME_PREFIX, "")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def has_extension(path: Column, *extensions: str) -> Column:
    """Case-sensitive suffix test."""
    matches = [F.endswith(path, F.lit(ext)) for ext in extensions]
    result = matches[0]
    for match in matches[1:]:
        result = result | match
    return result


def source_line(source: Column, page: Column) -> Column:
    """One footer line: the file name, with the page only if there is one."""
    name = basename(F.coalesce(source, F.lit(UNKNOWN_SOURCE)))
    paged = F.concat(F.lit("- "), name, F.lit(" (Pág. "), page.cast("string"), F.lit(")"))
    return F.when(page.isNotNull(), paged).otherwise(F.concat(F.lit("- "), name))


def chat_role(message_type: Column) -> Column:
    return F.when(message_type == "human", "user").otherwise("assistant")


def formatted_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def money(value: Column) -> Column:
    """Two decimals, without thousands separators."""
    return F.format_string("%.2f", value)
