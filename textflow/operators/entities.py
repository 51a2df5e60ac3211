"""Mentions of the phrases of a dictionary: names with labels, and links to known entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.functions import text as X
from textflow.functions.envelope import from_passages, to_passages
from textflow.functions.arrays import escaped
from textflow.functions.lookup import KeyFilter, LookupTable
from textflow.operators.enricher import Enricher
from textflow.operators.phrases import PhraseLists
from textflow.schemas import ANNOTATION, ANNOTATIONS, NAMED_ENTITIES

LINK_VALUES = ["entity_id", "entity_name", "entity_type", "rho", "confidence"]


def spelled(table: DataFrame) -> DataFrame:
    """The table with each `phrase` as its tokens joined by one blank, as runs of tokens are spelled."""
    tokens = X.class_tokens(F.col("phrase"))
    return table.withColumn("phrase", F.array_join(tokens, " ")).filter(F.col("phrase") != "")


def _length_key(length: Column, head: Column) -> Column:
    return F.concat_ws(" ", length.cast("string"), head)


class PhraseTable:
    """Phrases and the value structs they stand for, found in texts as runs of tokens.

    A mention within a strictly longer mention is left out; overlaps of equal length all stay.
    """

    def __init__(self, table: DataFrame, values: list[str], **limits) -> None:
        """`table` has a column `phrase` and the columns `values`."""
        known = spelled(table)
        self.phrases = LookupTable(known, "phrase", values, **limits)
        tokens = F.split("phrase", " ")
        heads = known.groupBy(tokens[0].alias("head")).agg(F.max(F.size(tokens)).alias("most"))
        self.heads = LookupTable(heads, "head", ["most"], **limits)
        self._longest = heads.agg(F.max("most").alias("most"))
        # For the join: which numbers of tokens a phrase may have that begins with a token.
        self.lengths = KeyFilter(known.select(_length_key(F.size(tokens), tokens[0]).alias("key")).distinct())
        self._none = "array<struct<i:int,n:int,key:string,found:array<struct<%s>>>>" % ",".join(
            f"{f.name}:{f.dataType.simpleString()}" for f in known.select(*values).schema.fields
        )

    @property
    def inline(self) -> bool:
        return self.phrases.inline

    @property
    def longest(self) -> int:
        """Tokens of the longest phrase."""
        if not hasattr(self, "_most"):
            self._most = self._longest.first()["most"] or 0
        return self._most

    def mentions(self, requests: DataFrame, tokens: str, output: str) -> DataFrame:
        """Requests with a list of structs `i, n, key, found`: place, tokens, phrase and values."""
        if self.inline:
            hits = X.bind(F.col(tokens), self._hits)
            return requests.withColumn(
                output, X.bind(hits, lambda listed: outermost(listed, self.longest))
            )
        joined = self.phrases.join(requests, X.bind(F.col(tokens), self._grams), output)
        listed = F.coalesce(output, F.array().cast(self._none))
        kept = X.bind(listed, lambda hits: outermost(hits, self.longest))
        return joined.withColumn(output, F.when(F.col(tokens).isNotNull(), kept))

    def _gram(self, tokens: Column, i: Column, n: Column) -> Column:
        return F.struct(
            i.alias("i"), n.alias("n"), X.span_text(tokens, i, n).alias("key")
        )

    def _grams(self, tokens: Column) -> Column:
        """Runs of tokens that may be phrases: only tokens with which a phrase of that many tokens begins make one."""
        lengths = lambda i: F.sequence(F.lit(1), F.least(F.lit(self.longest), F.size(tokens) - i))

        def of_place(token: Column, i: Column) -> Column:
            known = F.filter(lengths(i), lambda n: self.lengths.may_hold(_length_key(n, token)))
            return F.transform(known, lambda n: self._gram(tokens, i, n))

        return F.flatten(F.transform(tokens, of_place))

    def _hits(self, tokens: Column) -> Column:
        """Runs that are phrases; only tokens that begin a phrase are looked at further."""
        places = F.filter(
            F.transform(tokens, lambda _, i: i),
            lambda i: self.heads.find(F.get(tokens, i)).isNotNull(),
        )

        def found(i: Column) -> Column:
            most = self.heads.find(F.get(tokens, i))[0]["most"]
            lengths = F.sequence(F.lit(1), F.least(most, F.size(tokens) - i))
            grams = F.transform(lengths, lambda n: self._gram(tokens, i, n))
            looked_up = F.transform(
                grams, lambda g: g.withField("found", self.phrases.find(g["key"]))
            )
            return F.filter(looked_up, lambda g: g["found"].isNotNull())

        return F.flatten(F.transform(places, found))


def outermost(hits: Column, longest: int) -> Column:
    """The hits that lie in no strictly longer hit; `hits` is sorted by place and length.

    Of the hits that begin at one token the last is the longest and covers the others. After that, a
    hit that covers another begins up to `longest - 1` tokens before it, so it is among as many
    predecessors in the list.
    """

    def alone(firsts: Column) -> Column:
        def covered(hit: Column, k: Column) -> Column:
            start = F.greatest(k + 2 - longest, F.lit(1))
            end = hit["i"] + hit["n"]
            return F.exists(
                F.slice(firsts, start, k + 1 - start), lambda before: before["i"] + before["n"] >= end
            )

        return F.filter(firsts, lambda hit, k: ~covered(hit, k))

    last_of_place = F.filter(
        hits, lambda hit, k: F.coalesce(F.get(hits, k + 1)["i"] != hit["i"], F.lit(True))
    )
    return X.bind(last_of_place, alone)


class EntityNames(Enricher):
    """Names from a gazetteer with their labels, as a JSON list of `{name, label}`.

    With `wrapper` the list is the only field of an object, `{"<wrapper>": [...]}`.
    """

    def __init__(
        self, gazetteer: DataFrame, label: str = "OpenNER", wrapper: str | None = None, **limits
    ) -> None:
        """`gazetteer` has the columns `phrase, label`."""
        super().__init__(label)
        self.wrapper = wrapper
        self.form = NAMED_ENTITIES if wrapper is None else T.StructType().add(wrapper, NAMED_ENTITIES)
        self.table = PhraseTable(gazetteer, ["label"], **limits)
        self.lists = PhraseLists(gazetteer)

    @property
    def row_local(self) -> bool:
        return self.table.inline

    def named(self, requests: DataFrame) -> DataFrame:
        """Requests with `names`, a list of structs `name, label`."""
        tokenized = requests.withColumn("__tokens", X.class_tokens(F.col("text")))
        found = self.table.mentions(tokenized, "__tokens", "__mentions")
        pairs = lambda m: F.transform(
            m["found"], lambda v: F.struct(m["key"].alias("name"), v["label"].alias("label"))
        )
        return found.withColumn("names", F.flatten(F.transform("__mentions", pairs))).drop(
            "__tokens", "__mentions"
        )

    def enrich(self, requests: DataFrame) -> DataFrame:
        if not self.row_local:
            return self._enrich_by_chunk(requests)
        listed = F.col("names")
        if self.wrapper:
            listed = F.when(listed.isNotNull(), F.struct(listed.alias(self.wrapper)))
        return self.named(requests).withColumn("prediction", F.to_json(listed)).drop("names")

    def _enrich_by_chunk(self, requests: DataFrame) -> DataFrame:
        """As `enrich`; the lists come as JSON, so that no list of structs is made for each text."""
        listed = F.col("__listed")
        if self.wrapper:
            listed = F.concat(F.lit(f'{{"{escaped(self.wrapper)}":'), listed, F.lit("}"))
        return self.lists.listed(requests, "__listed").withColumn("prediction", listed).drop("__listed")


def collect_annotations(annotations: DataFrame) -> DataFrame:
    """All annotations of a passage as one list: `passage_id, prediction`."""
    listed = F.sort_array(F.collect_list(F.struct(*ANNOTATION.names)))
    return annotations.groupBy("passage_id").agg(F.to_json(listed).alias("prediction"))


def annotated_passages(
    annotations: DataFrame, passages: DataFrame, keep_unannotated: bool = True
) -> DataFrame:
    """Passages with the list of their annotations; `[]` for a passage without any, or left out."""
    collected = collect_annotations(annotations)
    joined = passages.join(collected, "passage_id", "left" if keep_unannotated else "inner")
    return joined.withColumn("prediction", F.coalesce("prediction", F.lit("[]")))


class EntityLinks(Enricher):
    """Mentions linked to every entity they may stand for.

    `rho` is the prior of the entity, `confidence` its share among the entities of the phrase; null, and
    absent in JSON, where the priors of the phrase add up to 0.
    """

    form = ANNOTATIONS

    def __init__(self, entities: DataFrame, label: str = "EntityLinks", **limits) -> None:
        """`entities` has the columns `phrase, entity_id, entity_name, entity_type, prior`."""
        super().__init__(label)
        known = spelled(entities)
        total = F.sum(F.col("prior").cast("decimal(20,10)")).cast("double")
        totals = known.groupBy("phrase").agg(total.alias("total"))
        shared = known.join(totals, "phrase").select(
            "phrase",
            F.col("entity_id").cast("int").alias("entity_id"),
            "entity_name",
            "entity_type",
            F.col("prior").cast("double").alias("rho"),
            F.try_divide(F.col("prior").cast("double"), F.col("total")).alias("confidence"),
        )
        self.table = PhraseTable(shared, LINK_VALUES, **limits)

    @property
    def row_local(self) -> bool:
        return self.table.inline

    def linked(self, requests: DataFrame) -> DataFrame:
        """Requests with `annotations`, a list of annotation structs sorted by place."""
        tokenized = requests.withColumn("__tokens", X.class_tokens(F.col("text")))
        found = self.table.mentions(tokenized, "__tokens", "__mentions")
        links = X.bind(F.col("__mentions"), lambda mentions: _links(F.col("text"), mentions))
        listed = F.when(F.col("text").isNotNull(), links)
        return found.withColumn("annotations", listed).drop("__tokens", "__mentions")

    def annotations(self, requests: DataFrame) -> DataFrame:
        """One row per annotation, with the id of the passage."""
        # The outer form: for the inner one Spark would compute the links a second time, in a filter.
        linked = self.linked(requests).select(
            F.col("id").alias("passage_id"), F.inline_outer("annotations")
        )
        return linked.filter(F.col("start").isNotNull())

    def enrich(self, requests: DataFrame) -> DataFrame:
        return self.linked(requests).withColumn("prediction", F.to_json("annotations")).drop(
            "annotations"
        )


class LinkedEntities(Enricher):
    """Links taken from a ready table of annotations."""

    form = ANNOTATIONS

    def __init__(
        self, annotations: DataFrame, label: str = "EntityLinks", keep_unannotated: bool = True
    ) -> None:
        super().__init__(label)
        self.given = annotations
        self.keep_unannotated = keep_unannotated

    def enrich(self, requests: DataFrame) -> DataFrame:
        others = [c for c in requests.columns if c not in ("id", "text")]
        passages = to_passages(requests) if not others else requests.withColumnsRenamed(
            {"id": "passage_id", "text": "passage"}
        )
        joined = annotated_passages(self.given, passages, self.keep_unannotated)
        return from_passages(joined, *others, "prediction")


def _is_blank(piece: Column) -> Column:
    return F.ascii(piece).isin(9, 10, 11, 12, 13, 32)


def _joined(pieces: Column, first: Column, count: Column) -> Column:
    return F.array_join(F.slice(pieces, first + 1, count), "")


def _links(text: Column, mentions: Column) -> Column:
    """One annotation struct for each entity of each mention; a text without mentions is not cut up."""
    listed = X.bind(X.class_pieces(text), lambda pieces: _links_in(pieces, mentions))
    return F.when(F.size(mentions) > 0, listed).otherwise(F.array().cast(ANNOTATIONS))


def _links_in(pieces: Column, mentions: Column) -> Column:
    """The offset of a mention is that of the mention before plus the characters between their begins,
    so each piece of the text is looked at once."""

    def of_places(places: Column) -> Column:
        spots = F.transform(
            mentions,
            lambda m: F.struct(
                F.get(places, m["i"]).alias("first"),
                F.get(places, m["i"] + m["n"] - 1).alias("last"),
                m["found"].alias("found"),
            ),
        )
        return X.bind(spots, of_spots)

    def of_spots(spots: Column) -> Column:
        before = lambda k: F.coalesce(F.get(spots, k - 1)["first"], F.lit(0))
        gaps = F.transform(
            spots, lambda s, k: F.length(_joined(pieces, before(k), s["first"] - before(k)))
        )
        return X.bind(
            X.bind(gaps, X.running_sums),
            lambda starts: F.flatten(
                F.transform(
                    spots,
                    lambda s, k: X.bind(
                        _joined(pieces, s["first"], s["last"] - s["first"] + 1),
                        lambda surface: annotations(s["found"], F.get(starts, k), surface),
                    ),
                )
            ),
        )

    def annotations(found: Column, start: Column, surface: Column) -> Column:
        return F.transform(
            found,
            lambda entity: F.struct(
                start.alias("start"),
                (start + F.length(surface)).alias("end"),
                surface.alias("mention"),
                *[entity[name].alias(name) for name in LINK_VALUES],
            ),
        )

    places = F.filter(
        F.transform(pieces, lambda _, k: k), lambda k: ~_is_blank(F.get(pieces, k))
    )
    return F.sort_array(X.bind(places, of_places))
