"""Tokens and words of a text, computed inside the row: none of these moves rows between tasks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The blanks that separate words, letters/digits/signs that form tokens, and the signs
# cut from both ends of a word before it is looked up in a lexicon.
BLANKS = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
TOKEN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]+"
TOKEN_OR_BLANKS = r"\s+|" + TOKEN
SIGN_AT_END = r"^\p{Punct}|\p{Punct}$"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, although `body` uses it several times."""
    return F.transform(F.array(value), body)[0]


def running_sums(values: Column) -> Column:
    """For each number of a list the sum up to it.

    Each pass adds the number that lies twice as far back as in the pass before, so a list takes
    about log2 of its length in passes.
    """
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int"))
    back = lambda p: F.pow(F.lit(2), p).cast("int")
    summed = F.aggregate(
        passes,
        values,
        lambda sums, p: F.transform(
            sums, lambda value, i: value + F.coalesce(F.get(sums, i - back(p)), F.lit(0))
        ),
    )
    return F.when(F.size(values) > 0, summed).otherwise(values)


def tokenize(rows: DataFrame, text: str = "text", output: str = "tokens") -> DataFrame:
    """Lower-cased text split at each single blank; empty tokens stay, except at the end."""
    given, plain = f"__{output}_given", f"__{output}_plain"
    split = Tokenizer(inputCol=plain, outputCol=given).transform(
        rows.withColumn(plain, F.coalesce(F.col(text), F.lit("")))
    )
    return split.withColumn(output, F.when(F.col(text).isNotNull(), F.col(given))).drop(given, plain)


def remove_stop_words(
    rows: DataFrame,
    tokens: str = "tokens",
    output: str = "filtered",
    language: str = "english",
    stop_words: Sequence[str] | None = None,
    case_sensitive: bool = False,
) -> DataFrame:
    """Tokens without the stop words of a language (or the given ones)."""
    listed = list(stop_words) if stop_words is not None else StopWordsRemover.loadDefaultStopWords(language)
    given, plain = f"__{output}_given", f"__{output}_plain"
    remover = StopWordsRemover(
        inputCol=plain, outputCol=given, stopWords=listed, caseSensitive=case_sensitive
    )
    filtered = remover.transform(
        rows.withColumn(plain, F.coalesce(F.col(tokens), F.array().cast("array<string>")))
    )
    return filtered.withColumn(output, F.when(F.col(tokens).isNotNull(), F.col(given))).drop(given, plain)


def token_count(tokens: Column) -> Column:
    return F.when(tokens.isNotNull(), F.size(tokens))


def total_words(text: Column) -> Column:
    """Parts between runs of blanks: a leading run counts one empty part, a trailing run none."""

    def count(parts: Column) -> Column:
        trailing = F.element_at(parts, -1) == ""
        only_blanks = (F.size(parts) == 2) & (parts[0] == "")
        return (
            F.when(~trailing, F.size(parts)).when(only_blanks, F.lit(0)).otherwise(F.size(parts) - 1)
        )

    return F.when(text == "", F.lit(1)).when(text.isNotNull(), bind(F.split(text, r"\s+"), count))


def words(text: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """Parts between runs of blanks, Unicode blanks included, without empty ones; on demand only those
    to keep."""
    wanted = (lambda word: (word != "") & keep(word)) if keep else (lambda word: word != "")
    return F.filter(F.split(text, BLANKS), wanted)


def word_counts(listed: Column) -> Column:
    """JSON list of `{word: count}`, in the order of the first occurrence of each word.

    Equal words are brought together by sorting the row's own words, so a document costs n log n and
    no shuffle, and two rows with the same id stay two results.
    """

    def runs(ordered: Column) -> Column:
        differs = lambda i: F.get(ordered, i - 1)["word"] != F.get(ordered, i)["word"]
        heads = F.filter(F.transform(ordered, lambda _, i: i), lambda i: (i == 0) | differs(i))

        def counts(heads: Column) -> Column:
            end = lambda k: F.coalesce(F.get(heads, k + 1), F.size(ordered))
            return F.transform(
                heads,
                lambda i, k: F.struct(
                    F.get(ordered, i)["place"].alias("place"),
                    F.get(ordered, i)["word"].alias("word"),
                    (end(k) - i).alias("n"),
                ),
            )

        return F.sort_array(bind(heads, counts))

    placed = F.transform(listed, lambda word, i: F.struct(word.alias("word"), i.alias("place")))
    counted = bind(F.sort_array(placed), runs)
    return F.to_json(F.transform(counted, lambda x: F.create_map(x["word"], x["n"])))


def class_tokens(text: Column) -> Column:
    """Runs of letters, of digits and of other signs."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def class_pieces(text: Column) -> Column:
    """As `class_tokens`, with the blanks between: the pieces joined give back the text."""
    return F.regexp_extract_all(text, F.lit(TOKEN_OR_BLANKS), F.lit(0))


def span_text(tokens: Column, start: Column, length: Column) -> Column:
    """The tokens of a span (0-based start) joined by one blank."""
    return F.array_join(F.slice(tokens, start + 1, length), " ")


def lexicon_terms(text: Column) -> Column:
    """The lower-cased parts between blanks, as `lexicon_term` writes them; some may be empty."""
    return F.transform(F.split(F.lower(text), BLANKS), lexicon_term)


def lexicon_term(word: Column) -> Column:
    """A word without signs at its ends; where two or fewer characters would be left, the signs stay."""
    bare = F.btrim(word, F.lit(PUNCTUATION))
    cut = word.rlike(SIGN_AT_END) & (F.length(bare) > 2)
    return F.when(cut, bare).otherwise(word)
