"""Licence scan: a sparse word n-gram classifier of paragraphs, confirmed by name templates.

The model is Spark ML's logistic regression, applied as a join of n-grams with its coefficients. All of
it is DataFrame operations: paragraphs with a word of the fixed wordings are split into words, and the
n-grams around such words are joined with the fixed ones, as they are, so lines wrapped inside a
paragraph are read on.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import plain_words, stage, text_key
from tallybrook.operators.once import with_columns_once

# Names of public licences, in lower case without punctuation.
NAMES = {
    "apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license"),
    "bsd-3-clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license"),
    "cc-by-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "cc-by-nc-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "cc-by-sa-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "cc0-1.0": ("cc0 1 0", "cc0 1 0 universal public domain dedication"),
    "gpl-2.0": ("gnu general public license version 2", "gpl version 2", "gpl 2 0"),
    "gpl-3.0": ("gnu general public license version 3", "gpl version 3", "gpl 3 0"),
    "lgpl-3.0": ("gnu lesser general public license version 3", "lgpl version 3", "lgpl 3 0"),
    "mit": ("mit license", "mit licence"),
    "mpl-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0"),
}
# Wordings around a name, and names of no family above.
CARRIERS = (
    "licensed under {}", "licensed under the {}", "released under the {}", "released under {}",
    "this work is licensed under the {}", "this work is licensed under {}", "distributed under the terms of the {}",
    "this file is subject to the {}", "you may use this under the {}", "{}",
)
OTHER_NAMES = (
    "example public license", "acme community license version 1", "company source license 1 1", "a custom license",
    "terms of use of the publisher", "proprietary license", "internal use license", "owner license agreement",
)
# Standard notices and leading paragraphs of the families' texts.
_GNU_NOTICE = "under the terms of the gnu {} public license as published by the free software foundation either version {} of the license or at your option any later version"
_GNU_ONLY = "under the terms of the gnu {} public license version {} as published by the free software foundation"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
NOTICES = {
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge "
        "royalty free irrevocable copyright license to reproduce prepare derivative works of",
    ),
    "bsd-3-clause": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission",
    ),
    "cc-by-4.0": ("terms and conditions of this creative commons attribution 4 0 international public license",),
    "cc-by-nc-4.0": ("terms and conditions of this creative commons attribution noncommercial 4 0 international public license",),
    "cc-by-sa-4.0": ("terms and conditions of this creative commons attribution sharealike 4 0 international public license",),
    "cc0-1.0": (
        "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of their rights to the work "
        "worldwide under copyright law",
    ),
    "gpl-2.0": (
        _GNU_NOTICE.format("general", "2"), _GNU_ONLY.format("general", "2"),
        "the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license "
        "is intended to guarantee your freedom to share and change free software",
    ),
    "gpl-3.0": (
        _GNU_NOTICE.format("general", "3"), _GNU_ONLY.format("general", "3"),
        "the gnu general public license is a free copyleft license for software and other kinds of works",
    ),
    "lgpl-3.0": (
        _GNU_NOTICE.format("lesser general", "3"), _GNU_ONLY.format("lesser general", "3"),
        "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license",
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense",
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}
# Short identifiers, and forms of them that name the family by themselves.
IDENTIFIERS = {
    "apache-2.0": "apache 2 0", "bsd-3-clause": "bsd 3 clause", "cc-by-4.0": "cc by 4 0", "cc-by-nc-4.0": "cc by nc 4 0",
    "cc-by-sa-4.0": "cc by sa 4 0", "cc0-1.0": "cc0 1 0", "gpl-2.0": "gpl 2 0", "gpl-3.0": "gpl 3 0", "lgpl-3.0": "lgpl 3 0",
    "mit": "identifier mit", "mpl-2.0": "mpl 2 0",
}
EXPRESSIONS = {
    "mit": ("license mit", "0 or mit", "clause or mit", "only or mit", "later or mit", "mit or apache", "mit or bsd", "mit or gpl", "mit or cc0", "mit or unlicense"),
}
# Names and texts of no family above that come near one of them.
OTHER_TEXTS = (
    "gnu affero general public license version 3", "agpl version 3", "agpl 3 0", _GNU_NOTICE.format("affero general", "3"), _GNU_ONLY.format("affero general", "3"),
    "gnu lesser general public license version 2 1", "gnu library general public license version 2",
    _GNU_NOTICE.format("library general", "2"), _GNU_NOTICE.format("lesser general", "2 1"), "isc license", _BSD,
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
)
#: Wordings around a notice, which has its own.
NOTICE_CARRIERS = ("{}", "copyright the authors {}", "{} copyright", "license {}")
UNKNOWN, NONE = "unknown", "none"

#: Documents and paragraphs, about and at most, from which the class without licence is learned.
SAMPLE_DOCUMENTS = 300
SAMPLE_PARAGRAPHS = 4000
#: Fixed words of the wordings that say nothing about licences by themselves, whatever the corpus.
FUNCTION_WORDS = frozenset("a and any as at be by for if in is it may not of on or that the this to under use with you your".split())
#: A line feed and the lines without words after it: what lies between paragraphs.
PARAGRAPH_END = r"\n(?:[^\p{L}\p{N}\p{M}\n]*\n)+"
#: Words at most of a piece of a sampled line.
SAMPLE_WORDS = 40
#: Share of a sampled piece's n-grams from which it is like the wordings and no example of text without licence.
ALIKE = 0.3
#: Share of the word pairs of a name or notice that a paragraph must hold to confirm the family.
CONFIRM = 0.8
#: Words from one window over a paragraph to the next; a window has twice as many, so a run of up to
#: so many words lies whole in one.
STEP_WORDS = 100
#: Probability below which a paragraph with licence wording is of unknown family.
FAMILY_PROBABILITY = 0.5
#: Scales tried when the probabilities are calibrated.
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)


def grams(words: Column) -> Column:
    """The distinct pairs and triples of neighbouring words."""

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
        return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(runs(2), runs(3)))


def paragraphs(documents: DataFrame) -> DataFrame:
    """(text_id, place, words) of every line that has words; equal texts give equal rows."""
    lines = documents.where("text IS NOT NULL").select(text_key(F.col("text")).alias("text_id"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return lines.select("text_id", "place", F.split(plain_words(F.col("line")), " ").alias("words")).where("words[0] <> ''")


def _rows(spark: SparkSession, values: list[tuple], ddl: str) -> DataFrame:
    """A small table from one literal."""
    names = [field.split()[0] for field in ddl.split(", ")]
    literal = json.dumps([dict(zip(names, row)) for row in values])
    kind = ", ".join(field.replace(" ", ":", 1) for field in ddl.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(literal), f"array<struct<{kind}>>")))


def _pairs(name: str) -> list[str]:
    """The pairs of neighbouring words that are not function words alone."""
    words = name.split()
    return [" ".join(words[i : i + 2]) for i in range(len(words) - 1) if not set(words[i : i + 2]) <= FUNCTION_WORDS]


def _templates() -> dict[tuple[str, str], list[str]]:
    """The distinct word pairs of every (family, wording): names, notices, identifiers and near ones of no family."""
    parts = [(f, n) for table in (NAMES, NOTICES, EXPRESSIONS) for f, names in table.items() for n in names]
    parts += [*IDENTIFIERS.items(), *((UNKNOWN, text) for text in OTHER_TEXTS)]
    return {(family, name): sorted(set(_pairs(name))) for family, name in parts}


def _has_number(gram: str) -> bool:
    return any(word.isdigit() for word in gram.split())


def name_templates(spark: SparkSession) -> DataFrame:
    """(family, name, gram, pairs, numbers, number, rivals): the word pairs of every licence name.

    ``numbers`` counts the name's pairs with a number, ``number`` says whether this one has any.
    ``rivals`` are other families' names with so many of the same pairs that they come near this one.
    """
    templates = _templates()
    rows = []
    for (family, name), pairs in templates.items():
        rivals = [n for (f, n), other in templates.items() if f != family and len(set(pairs) & set(other)) >= CONFIRM * len(pairs)]
        rows += [(family, name, pair, len(pairs), sum(map(_has_number, pairs)), int(_has_number(pair)), rivals) for pair in pairs]
    return _rows(spark, rows, "family string, name string, gram string, pairs int, numbers int, number int, rivals array<string>")


def find_grams(documents: DataFrame, grams_: list[str]) -> DataFrame:
    """(text_id, place, column, paragraph, at, whole, gram): where each text holds one of the pairs and triples.

    ``place`` names the line in which the n-gram starts, ``column`` is its word there and ``at`` counts
    the words of its paragraph, which ends at a line without words. ``whole`` is whether it ends in
    the same line. Paragraphs without any telling word (of the n-grams, no function word or number)
    are left out: nothing in them has weight or can confirm a name. The n-grams are a fixed list, of no
    size that follows the input.
    """
    words = sorted({word for gram in grams_ for word in gram.split()})
    numbers = [word for word in words if word.isdigit()]
    telling = [word for word in words if word not in FUNCTION_WORDS and not word.isdigit()]
    texts = documents.where("text IS NOT NULL").select(
        text_key(F.col("text")).alias("text_id"), F.posexplode(F.split("text", PARAGRAPH_END)).alias("paragraph", "part")
    )
    told = F.exists(F.split(plain_words(F.col("part")), " "), lambda word: word.isin(telling))
    lines = F.transform(F.split("part", "\n"), plain_words)
    tokens = F.flatten(F.transform(lines, lambda line, n: F.transform(
        F.filter(F.split(line, " "), lambda word: word != ""), lambda word, c: F.struct(n.alias("line"), c.alias("column"), word.alias("word"))
    )))
    texts = with_columns_once(texts.where(told), {"tokens": tokens}).drop("part")
    token = lambda i: F.get(F.col("tokens"), i)
    word = lambda i: token(i)["word"]

    def near(i: Column) -> Column:
        known, says = word(i).isin(words) & word(i + 1).isin(words), telling + numbers
        said = word(i).isin(says) | word(i + 1).isin(says) | F.coalesce(word(i + 2).isin(says), F.lit(False))
        return F.coalesce(known & said, F.lit(False))

    def both(i: Column) -> Column:
        pair = F.concat(word(i), F.lit(" "), word(i + 1))
        return F.array(*[
            F.struct(
                i.alias("at"), token(i)["line"].alias("line"), token(i)["column"].alias("column"),
                (token(i)["line"] == token(i + n - 1)["line"]).alias("whole"), gram.alias("gram"),
            )
            for n, gram in ((2, pair), (3, F.concat(pair, F.lit(" "), word(i + 2))))
        ])

    starts = F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), near)
    # The words stay behind: a hit holds all that is needed of them.
    found = texts.where(F.size("tokens") > 1).select("text_id", "paragraph", F.explode(F.flatten(F.transform(starts, both))).alias("hit"))
    place = F.shiftleft(F.col("paragraph").cast("long"), 32) + F.col("hit.line")
    found = found.select("text_id", place.alias("place"), "hit.column", "paragraph", "hit.at", "hit.whole", "hit.gram")
    fixed = _rows(documents.sparkSession, [(gram,) for gram in sorted(set(grams_))], "gram string")
    return found.join(F.broadcast(fixed), "gram").select("text_id", "place", "column", "paragraph", "at", "whole", "gram")


def train(documents: DataFrame) -> tuple[list[tuple[str, str, float]], dict[str, float], float]:
    """Weights (gram, class, weight), class intercepts and temperature.

    Positive rows are the names in their wordings, the notices and the short identifiers, rows of the unknown class the other names; the
    class without licence comes from paragraphs of documents whose text hash falls in a fixed part
    of the whole, about ``SAMPLE_DOCUMENTS``, that are not like a licence name. The model's n-grams
    all hold a trigger: a word of the fixed wordings that is no function word or number, so the
    corpus has no say in which rows are scored. Every other row is held
    out of a first fit, to choose the temperature at which its probabilities fit best.
    """
    spark = documents.sparkSession
    total = max(documents.count(), 1)
    sample = documents.where(F.pmod(F.xxhash64("text"), F.lit(total)) < SAMPLE_DOCUMENTS)
    starts = F.sequence(F.lit(0), F.floor((F.size("words") - 1) / SAMPLE_WORDS))
    pieces = F.transform(starts, lambda i: F.slice("words", i.cast("int") * SAMPLE_WORDS + 1, F.lit(SAMPLE_WORDS)))
    plain = paragraphs(sample).select(F.explode(pieces).alias("words"))
    plain = plain.select("words", F.array_join("words", " ").alias("line")).dropDuplicates(["line"])
    plain = stage(plain.orderBy(F.xxhash64("line"), "line").limit(SAMPLE_PARAGRAPHS), "licence-sample")
    known = [(family, carrier.format(name)) for family, names in NAMES.items() for name in names for carrier in CARRIERS]
    known += [(UNKNOWN, carrier.format(name)) for name in OTHER_NAMES for carrier in CARRIERS]
    noticed = [(c, text) for table in (NOTICES, EXPRESSIONS) for c, texts in table.items() for text in texts]
    noticed += [*IDENTIFIERS.items(), *((UNKNOWN, text) for text in OTHER_TEXTS)]
    noticed += [(c, "spdx license identifier " + name.removeprefix("identifier ")) for c, name in IDENTIFIERS.items()]
    known += [(c, carrier.format(text)) for c, text in noticed for carrier in NOTICE_CARRIERS]
    own_grams = sorted({" ".join(w[i : i + n]) for _, line in known for w in [line.split()] for n in (2, 3) for i in range(len(w) - n + 1)})
    held = F.size(F.array_intersect(grams(F.col("words")), F.lit(own_grams)))
    names = F.array(*[F.lit(pairs) for pairs in _templates().values()])
    plain = plain.where(~F.exists(names, lambda name: F.size(F.array_intersect(grams(F.col("words")), name)) >= CONFIRM * F.size(name)))
    plain = plain.where((held < ALIKE * F.size(grams(F.col("words")))) | (F.size("words") < 2))
    triggers = sorted({word for _, line in known for word in line.split() if word not in FUNCTION_WORDS and not word.isdigit()})
    vocabulary = [gram for gram in own_grams if set(gram.split()) & set(triggers)]
    classes = [*NAMES, UNKNOWN, NONE]
    rows = _rows(spark, [(classes.index(c), line) for c, line in known], "label double, line string").unionByName(
        plain.select(F.lit(float(classes.index(NONE))).alias("label"), "line")
    )
    rows = rows.select("label", "line", grams(F.split("line", " ")).alias("grams"))
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    vectorizer.setBinary(True)
    rows = stage(vectorizer.transform(rows).select("label", "line", "features"), "licence-training")
    fit = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60)
    held_out = F.pmod(F.xxhash64("line"), F.lit(2)) == 1
    half = fit.fit(rows.where(~held_out))
    temperature = _temperature(half.transform(rows.where(held_out)))
    model = fit.fit(rows)
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = [
        (gram, classes[c], float(matrix[c, g])) for g, gram in enumerate(vocabulary) for c in range(matrix.shape[0]) if matrix[c, g]
    ]
    return weights, {classes[c]: float(v) for c, v in enumerate(intercepts)}, temperature


def _temperature(scored: DataFrame) -> float:
    raw = scored.select(F.col("label").cast("int").alias("label"), vector_to_array("rawPrediction").alias("raw"))

    def loss(t: float) -> Column:
        whole = F.log(F.aggregate("raw", F.lit(0.0), lambda s, x: s + F.exp(x / t)))
        return F.avg(whole - F.element_at("raw", F.col("label") + 1) / t)

    losses = [loss(t) for t in TEMPERATURES]
    row = raw.where(F.col("label") < F.size("raw")).agg(*[x.alias(f"t{i}") for i, x in enumerate(losses)]).first()
    return min(TEMPERATURES, key=lambda t: math.inf if row[TEMPERATURES.index(t)] is None else row[TEMPERATURES.index(t)])


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, licences, unknown_paragraphs, licence_paragraphs, probability) of every document.

    ``licences`` lists the confirmed families in order, an empty list if there is none. Families are
    looked for in lines and in paragraphs (up to a line without words), so a statement may be
    wrapped; both are read in windows of twice ``STEP_WORDS`` words that overlap by half. Every
    family counts, one against the class without licence, if its probability reaches one half and
    one of its names, notices or identifiers confirms it: with ``CONFIRM`` of the name's pairs, all that hold a number among
    them, and, if not all pairs are there, no rival name that fits better. A line of a licence class
    of which no pair belongs to a confirmed name is of unknown family. Only n-grams with a trigger
    word have weights and every name holds one, so a line without one can't be of a licence class.
    Null and empty texts have no paragraphs. Equal texts are scanned once and joined back over
    written tables; repeated rows each keep theirs.
    """
    spark = documents.sparkSession
    weights, intercepts, temperature = train(documents)
    table = _rows(spark, [(g, c, w) for g, c, w in weights], "gram string, class string, weight double")
    table = stage(table, "licence-weights")  # as large as the fixed names make it
    templates = name_templates(spark)
    known = sorted({g for g, _, _ in weights} | {pair for pairs in _templates().values() for pair in pairs})
    found = stage(find_grams(documents, known).distinct(), "licence-grams")
    windows = lambda at: F.explode(F.array_distinct(F.array(F.floor(at / STEP_WORDS), F.greatest(F.floor(at / STEP_WORDS) - 1, F.lit(0)))))
    in_lines = found.where("whole").select("text_id", F.lit("line").alias("unit"), F.col("place").alias("part"), windows(F.col("column")).alias("window"), "place", "gram")
    in_paragraphs = found.select("text_id", F.lit("paragraph").alias("unit"), F.col("paragraph").alias("part"), windows(F.col("at")).alias("window"), "place", "gram")
    units = in_lines.unionByName(in_paragraphs)
    keys = ["text_id", "unit", "part", "window"]
    sums = units.select(*keys, "gram").distinct().join(F.broadcast(table), "gram").groupBy(*keys).pivot("class", list(intercepts)).agg(F.sum("weight"))
    score = lambda c: (F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) + intercepts[c]) / temperature
    scores = sums.select(*keys, F.array(*[F.struct(score(c).alias("score"), F.lit(c).alias("class")) for c in intercepts]).alias("scores"))
    best, none = F.array_max("scores"), F.filter("scores", lambda x: x["class"] == NONE)[0]["score"]
    share = F.exp(best["score"]) / F.aggregate("scores", F.lit(0.0), lambda s, x: s + F.exp(x["score"]))
    against_none = F.map_from_entries(F.transform("scores", lambda x: F.struct(x["class"], 1 / (1 + F.exp(none - x["score"])))))
    scores = stage(scores.select(*keys, best["class"].alias("class"), share.alias("share"), against_none.alias("chances")), "licence-scores")

    held = units.join(F.broadcast(templates), "gram").groupBy(*keys, "family", "name", "pairs", "numbers", "rivals").agg(
        F.count_distinct("gram").alias("_held"), F.count_distinct(F.when(F.col("number") == 1, F.col("gram"))).alias("_numbers"),
        F.collect_set("place").alias("places"),  # of one window
    )
    likeness = F.when(F.col("_numbers") == F.col("numbers"), F.col("_held") / F.col("pairs")).otherwise(F.lit(0.0))
    alike = held.groupBy(*keys).agg(F.collect_list(F.struct("family", "name", likeness.alias("similarity"), "rivals", "places")).alias("names"))
    better = lambda x: F.exists("names", lambda y: F.array_contains(x["rivals"], y["name"]) & (y["similarity"] > x["similarity"]))
    fitting = F.filter("names", lambda x: (x["family"] != UNKNOWN) & (x["similarity"] >= CONFIRM) & ((x["similarity"] == 1) | ~better(x)))
    confirmed = alike.select(*keys, F.explode(fitting).alias("_name")).select(*keys, "_name.family", "_name.places").join(scores, keys)
    confirmed = confirmed.withColumn("probability", F.col("chances")[F.col("family")]).where(F.col("probability") >= FAMILY_PROBABILITY)
    confirmed = stage(confirmed.select("text_id", "family", "places", "probability"), "licence-confirmed")
    lines = scores.where((F.col("unit") == "line") & (F.col("class") != NONE)).groupBy("text_id", F.col("part").alias("place")).agg(
        F.max("share").alias("probability")
    )
    explained = confirmed.select("text_id", F.explode("places").alias("place"), "family", "probability")
    judged = lines.select("*", F.lit(None).cast("string").alias("family")).unionByName(explained).groupBy("text_id", "place").agg(
        F.collect_set("family").alias("families"), F.max("probability").alias("probability")
    )
    judged = judged.select("text_id", "place", F.explode_outer("families").alias("family"), "probability")
    per_text = judged.groupBy("text_id").agg(
        F.array_sort(F.collect_set("family")).alias("licences"),  # a set of the fixed families
        F.count_if(F.col("family").isNull()).alias("unknown_paragraphs"),
        F.count_distinct("place").alias("licence_paragraphs"),
        F.round(F.max("probability"), 6).alias("probability"),
    )
    per_text = stage(per_text, "licence-texts")
    ids = stage(documents.select("doc_id", text_key(F.col("text")).alias("text_id")), "licence-ids")
    return ids.join(per_text, "text_id", "left").select(
        "doc_id",
        F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
        F.coalesce("unknown_paragraphs", F.lit(0)).alias("unknown_paragraphs"),
        F.coalesce("licence_paragraphs", F.lit(0)).alias("licence_paragraphs"),
        "probability",
    )
