"""Personal data in texts: patterns propose spans, checksums confirm them, words near them adjust the score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.functions.text import bind, running_sums
from textflow.llm.tables import without

# Code points before and after a span in which context words are looked for.
NEARBY = 40
ACCEPTED = 0.5
SPANS = "array<struct<start:int,place:int,kind:string,end:int,score:double>>"


@dataclass(frozen=True)
class Kind:
    """`hint` is a cheap test that any text with a match passes. A match that passes the check has `score`;
    a context word nearby adds `boost`. Spans below `ACCEPTED` are dropped."""

    name: str
    pattern: str
    hint: str
    score: float
    boost: float
    context: str


# The patterns. A run is taken whole (`++`), and a match starts where its run starts or where the last
# match ended (`\G`), so a long run without a match is read once. The kinds of the base come first and are
# always kept when their check holds.
_WORD, _NAME = r"A-Za-z0-9._%+-", r"A-Za-z0-9-"
# The longest run of groups that an account number may begin. Its match is the first letter, so that runs may overlap;
# group 1 is the run with what follows it.
_ACCOUNT = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
ACCOUNT_SIGNS = (15, 34)
# Matches that may begin within `NEARBY` signs before one: none has fewer signs than two with what parts it from the next.
MATCHES_NEARBY = NEARBY // 2
# Context words are whole words, or begin one where a longer one means the same: "tel" is not in "hotel", "call" not in
# "locally".
_CALLS = (
    r"\b(?:(?:tele|mobil|smart)?(?:ph|f)on\p{L}*|(?:cell|phone)s?|call(?:s|ed|ing)?|tel|mobile?s?|m\u00f3vil|handy"
    r"|ruf\p{L}*|anruf\p{L}*|appel(?:s|er|ez)?|llam\p{L}*|tel\u00e9fono\p{L}*|t\u00e9l\u00e9phon\p{L}*)\b"
)
_MAILS = r"\be?-?mail\p{L}*|\bcontact|\bschreib|\bcorreo|\bcourriel"
_CARDS = r"\b(?:credit|kredit)?(?:cards?|karten?|cartes?|tarjetas?)\b|\bvisa\b|\bmastercard\b|\bcr[e\u00e9]dit\p{L}*"
_SECRETS = r"(?<![a-z])(?:secret|token|passw(?:or)?d|passwort|credential|api[_ -]?key|access[_ -]?key|private[_ -]?key|bearer)"
KINDS = (
    Kind("email", rf"(?:(?<![{_WORD}])|\G)[{_WORD}]++@[{_NAME}]++(?:\.[{_NAME}]++)++", "@", 0.9, 0.1, _MAILS),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.", 0.6, 0.3, r"\bip\b|\baddress|\bserver|\bhosts?\b|\badresse|\bdirecci"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", 0.8, 0.2, _CARDS),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, 0.3, _CALLS),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=({_ACCOUNT}[\s\S]{{0,{NEARBY}}}))[A-Z]", r"[A-Z]{2}[0-9]{2}", 0.9, 0.1, r"\biban|\baccount|\bbank|\bkonto|\bcompte|\bcuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]", 0.3, 0.4, r"\bssn\b|\bsocial security|\bsozialvers|\bseguridad social"),
    Kind("local_phone", r"(?<![0-9+().-])\(?[0-9]{2,4}\)?[\x20-][0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9-])", r"[0-9]{2}\)?[\x20-][0-9]{3}", 0.3, 0.4, _CALLS),
    Kind("secret", r"(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{20,}+", r"[A-Za-z0-9+_-]{20}", 0.3, 0.6, _SECRETS),
)
BASE = ("email", "ip", "card", "phone")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether digits pass the Luhn test: from the right, every second digit counts double, 9 less if above 9."""

    def summed(d: Column) -> Column:
        def value(i: Column) -> Column:
            digit = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            return F.when(i % 2 == 0, digit).when(digit < 5, digit * 2).otherwise(digit * 2 - 9)

        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda total, i: total + value(i))

    return bind(digits, summed) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without blanks has the remainder 1: its first four signs moved to the end, letters
    read as 10 to 35, digit by digit."""

    def remainder(account: Column) -> Column:
        signs = F.split(F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4)), "")

        def step(rest: Column, sign: Column) -> Column:
            letter = F.ascii(sign) - 55
            return F.when(sign.rlike("[0-9]"), (rest * 10 + sign.cast("int")) % 97).otherwise(
                (rest * 100 + letter) % 97
            )

        return F.aggregate(F.filter(signs, lambda s: s != ""), F.lit(0), step)

    return bind(iban, remainder) == 1


def _confirmed(kind: str, found: Column) -> Column:
    digits = F.length(_digits(found))
    if kind == "ip":
        parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return digits.between(12, 19) & luhn(_digits(found))
    if kind == "phone":
        return digits.between(9, 15)
    if kind == "iban":
        return mod97(F.replace(found, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~found.rlike(r"^(000|666|9)|-00-|-0000$")
    if kind == "local_phone":
        return digits.between(8, 11)
    if kind == "secret":
        return (digits >= 4) & (F.length(F.regexp_replace(found, "[^A-Za-z]", "")) >= 4)
    return F.lit(True)


def _before(gaps: Column, found: Column, i: Column) -> Column:
    """The last `NEARBY` signs of the text before match `i`, from the ends of the pieces before it."""
    first = F.greatest(i - MATCHES_NEARBY, F.lit(0))
    pieces = F.transform(
        F.sequence(first, i),
        lambda k: F.concat(F.right(F.get(gaps, k), F.lit(NEARBY)), F.when(k < i, F.right(F.get(found, k), F.lit(NEARBY))).otherwise("")),
    )
    return F.right(F.array_join(pieces, ""), F.lit(NEARBY))


def _after(gaps: Column, found: Column, i: Column) -> Column:
    """The first `NEARBY` signs of the text after match `i`."""
    last = F.least(i + MATCHES_NEARBY, F.size(found) - 1)
    pieces = F.transform(
        F.sequence(i, last),
        lambda k: F.concat(F.when(k > i, F.left(F.get(found, k), F.lit(NEARBY))).otherwise(""), F.left(F.get(gaps, k + 1), F.lit(NEARBY))),
    )
    return F.left(F.array_join(pieces, ""), F.lit(NEARBY))


def _score(kind: Kind, before: Column, after: Column) -> Column:
    near = F.concat(before, F.lit(" "), after)
    return F.round(F.lit(kind.score) + F.when(F.lower(near).rlike(kind.context), kind.boost).otherwise(0.0), 2)


def _span(kind: Kind, place: int, start: Column, end: Column, score: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(place).alias("place"),
        F.lit(kind.name).alias("kind"),
        end.cast("int").alias("end"),
        score.alias("score"),
    )


def _accounts(text: Column, kind: Kind, place: int) -> Column:
    """Account numbers: from each place where one may begin, the longest run of whole groups with the remainder 1. What
    begins inside an accepted one is left out."""

    def located(runs: Column) -> Column:
        def of_gaps(gaps: Column) -> Column:
            letters = F.transform(runs, lambda r: F.left(r, F.lit(1)))
            ends = running_sums(F.transform(runs, lambda r, i: F.length(F.get(gaps, i)) + 1))

            def with_ends(ends: Column) -> Column:
                def span(run: Column, i: Column) -> Column:
                    def of_account(account: Column) -> Column:
                        start = F.get(ends, i) - 1
                        n = F.length(account)
                        after = F.substring(run, n + 1, F.lit(NEARBY))
                        score = _score(kind, _before(gaps, letters, i), after)
                        return F.when(account.isNotNull(), _span(kind, place, start, start + n, score))

                    def of_groups(groups: Column) -> Column:
                        heads = F.transform(
                            F.sequence(F.size(groups), F.lit(1)), lambda k: F.array_join(F.slice(groups, F.lit(1), k), " ")
                        )
                        signs = lambda h: F.length(F.replace(h, F.lit(" "), F.lit("")))
                        good = F.filter(heads, lambda h: signs(h).between(*ACCOUNT_SIGNS) & _confirmed(kind.name, h))
                        return bind(F.get(good, F.lit(0)), of_account)

                    return bind(F.split(F.regexp_extract(run, "^" + _ACCOUNT, 0), " "), of_groups)

                return F.filter(F.transform(runs, span), lambda s: s.isNotNull() & (s["score"] >= ACCEPTED))

            return bind(ends, with_ends)

        return bind(F.split(text, kind.pattern, -1), of_gaps).cast(SPANS)

    def apart(spans: Column) -> Column:
        taken = lambda kept, s: F.coalesce(F.element_at(kept, F.size(kept))["end"] > s["start"], F.lit(False))
        one_by_one = F.aggregate(
            spans,
            F.array().cast(SPANS),
            lambda kept, s: F.when((F.size(kept) > 0) & taken(kept, s), kept).otherwise(F.concat(kept, F.array(s))).cast(SPANS),
        )
        return F.when(F.size(spans) < 2, spans).otherwise(one_by_one)

    return bind(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1)),
        lambda runs: F.when(F.size(runs) > 0, bind(located(runs), apart)).otherwise(F.array().cast(SPANS)),
    )


def _matches(text: Column, kind: Kind, place: int) -> Column:
    """Accepted spans of a kind whose matches are its spans: the text between matches and the matches themselves give
    the offsets."""

    def located(found: Column) -> Column:
        def of_gaps(gaps: Column) -> Column:
            moved = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))

            def with_ends(ends: Column) -> Column:
                def span(m: Column, i: Column) -> Column:
                    end = F.get(ends, i)
                    score = _score(kind, _before(gaps, found, i), _after(gaps, found, i))
                    return F.when(_confirmed(kind.name, m), _span(kind, place, end - F.length(m), end, score))

                return F.filter(F.transform(found, span), lambda s: s.isNotNull() & (s["score"] >= ACCEPTED))

            return bind(running_sums(moved), with_ends)

        return bind(F.split(text, kind.pattern, -1), of_gaps).cast(SPANS)

    return bind(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, located(found)).otherwise(F.array().cast(SPANS)),
    )


def _spans(text: Column, kind: Kind, place: int) -> Column:
    spans = (_accounts if kind.name == "iban" else _matches)(text, kind, place)
    hinted = F.contains(text, F.lit("@")) if kind.hint == "@" else text.rlike(kind.hint)
    return F.when(hinted, spans).otherwise(F.array().cast(SPANS))


def find(rows: DataFrame, text: str = "text", output: str = "pii") -> DataFrame:
    """Rows with all spans of personal data in the whole text, as a list of (start, place of the kind, kind, end,
    score) in the order of start and kind; offsets are code points, the end exclusive.

    Per kind, spans are leftmost and don't overlap; a match that fails its check is dropped and not tried again.
    The base kinds are always kept then. Signs after an `iban` may look like more of it: the longest run of
    whole groups with the remainder 1 of 97 counts. `ssn`, `local_phone` and `secret` (keys and tokens: runs of 20 signs
    or more with four digits and four letters) are weak patterns, which only a context word within 40 code points of text
    makes count, whatever else stands between. Null and empty texts have no spans. All work is in
    the row and nearly linear in its length, so copies and frequent values cost no shuffle.
    A column of the output's name is replaced.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    parts = [_spans(value, kind, i) for i, kind in enumerate(KINDS)]
    # Nearly all texts lack digits and at signs; those are done after one look.
    spans = F.when(value.rlike("[0-9@]"), F.array_sort(F.concat(*parts))).otherwise(F.array().cast(SPANS))
    return rows.withColumn(output, spans) if output == text else without(rows, output).withColumn(output, spans)


def listed(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(rows: DataFrame, text: str = "text", pii: str = "pii") -> DataFrame:
    """Rows whose spans are replaced by `<KIND>` in the text. Of overlapping spans the first one names the kind and
    the others are covered by it or cut to what follows."""

    def pieces(spans: Column) -> Column:
        ends = F.transform(
            spans, lambda s, i: F.coalesce(F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda x: x["end"])), F.lit(0))
        )
        return F.transform(
            spans,
            lambda s, i: F.when(
                s["end"] <= F.get(ends, i), F.lit("")
            ).otherwise(
                F.concat(
                    F.substring(F.col(text), F.get(ends, i) + 1, F.greatest(s["start"] - F.get(ends, i), F.lit(0))),
                    F.lit("<"),
                    F.upper(s["kind"]),
                    F.lit(">"),
                )
            ),
        )

    last = F.coalesce(F.array_max(F.transform(pii, lambda s: s["end"])), F.lit(0))
    rest = F.substring(F.col(text), last + 1, F.length(text))
    done = F.concat(F.array_join(bind(F.col(pii), pieces), ""), rest)
    return rows.withColumn(text, F.when(F.size(pii) > 0, done).otherwise(F.col(text)))
