"""License scans: sparse TF-IDF cosine of passages to templates, then inheritance along directories.

Passages of a file, licence file or not, are the stretches of its words that hold a
word of a licence, copyright or permission, are no longer than the template they meet,
and begin and end with such a word or with one of the template's; line ends do not
count. The best cosine over all of them is the template's, so the length of the file
around a notice changes nothing. Terms are weighted by tf * idf, idf over the
templates; terms no template has weigh as the rarest. Words near a licence word meet
templates by a join on terms, once per distinct neighbourhood in the whole table.
A file whose best cosine is below `threshold` inherits from the nearest ancestor
directory that holds a licence file with a verdict: ancestors of each distinct
directory are joined by path, then files by directory.

Defined cases: null and empty texts and texts without a licence word have no verdict of
their own; null paths inherit nothing; ties between templates go to the first name,
between licence files of one directory to the better cosine, then the first name;
repeated rows are judged alike; a template table without rows gives no verdict; a
licence may have several templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from .common import cut_lineage, table, words

THRESHOLD = 0.6
CUE = r"(?i)licen[sc]e|copyright|permission|redistribut"
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|notice)([._-].*)?$"
# Short notices; fixed names, own wording where a notice has no fixed text.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
# Identifiers, and sentences of the licences' own notices and texts. Passages meet them one by one.
NOTICES = (
    # Not MIT: its one rare word is German for "with", and its identifier meets the short notice.
    *((name, f"SPDX-License-Identifier: {name}") for name, _ in TEMPLATES if name != "MIT"),
    # Neighbours that would else count as the licence they resemble.
    *((name, f"SPDX-License-Identifier: {name}") for name in ("BSD-2-Clause", "GPL-2.0", "LGPL-3.0", "AGPL-3.0", "CC-BY-SA-4.0")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*TEMPLATES, *NOTICES], "license string, text string")


def _terms(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf), tf = 1 + ln(count)."""
    return rows.select(key, F.explode(words(text)).alias("term")).groupBy(key, "term").agg((1 + F.log(F.count("*"))).alias("tf"))


def _near_cues(text: Column, reach: int) -> Column:
    """Per licence word: the words less than `reach` places from it, and its place among them."""

    def listed(w: Column) -> Column:
        cues = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: F.get(w, i - 1).rlike(CUE))
        first = lambda c: F.greatest(c - (reach - 1), F.lit(1))
        return F.transform(cues, lambda c: F.struct(F.slice(w, first(c), c + reach - first(c)).alias("near"), (c - first(c)).alias("cue")))

    return let(words(text), listed)


def _stretches(rows: DataFrame) -> DataFrame:
    """One row per stretch, `since` to `until`, of each passage and template: at most `length` words that hold the cue."""
    # Places of the template's terms and of the cue; a stretch begins and ends at one of them.
    ends = F.array_union(F.col("spots"), F.array("cue"))
    since = F.filter(ends, lambda x: (x <= F.col("cue")) & (x > F.col("cue") - F.col("length")))
    until = F.filter(ends, lambda x: (x >= F.col("cue")) & (x < F.col("since") + F.col("length")))
    begun = rows.select("passage", "template", "near", "cue", "spots", "length", F.explode(since).alias("since"))
    return begun.select("passage", "template", "near", "since", F.explode(until).alias("until"))


def own_licenses(files: DataFrame, known: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(evidence_key, license, score) of distinct texts that reach the threshold; `files`: evidence_key, evidence."""
    named = known.select("license", "text", F.xxhash64("license", "text").alias("template"), F.size(words("text")).alias("length"))
    named = cut_lineage(named.dropDuplicates(["template"]), "templates")
    t = cut_lineage(_terms(named, "template", "text").join(named.select("template", "license", "length"), "template"), "template-terms")
    count = named.select("license").distinct().agg(F.count("*").alias("n"))
    idf = t.groupBy("term").agg(F.countDistinct("license").alias("df")).withColumn("idf", F.log((count.scalar() + 1) / F.col("df")) + 1)
    idf = cut_lineage(idf.select("term", "idf"), "idf")
    rarest = count.select(F.log(F.col("n") + 1) + 1).scalar()
    wt = t.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = wt.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("template_norm"))
    wt = cut_lineage(wt.join(norms, "template").select("template", "length", "term", (F.col("w") / F.col("template_norm")).alias("share")), "shares")
    reach = named.agg(F.max("length").alias("n")).first()["n"] or 1
    spoken = files.select("evidence_key", F.inline(_near_cues(F.col("evidence"), reach)))
    spoken = spoken.withColumn("passage", F.xxhash64("near", "cue"))
    links = cut_lineage(spoken.select("evidence_key", "passage", "near", "cue"), "links")
    passages = cut_lineage(links.groupBy("passage").agg(F.first("near").alias("near"), F.first("cue").alias("cue")), "passages")
    spots = passages.select("passage", F.posexplode("near").alias("at", "term")).join(wt, "term")
    spots = spots.groupBy("passage", "template").agg(F.first("length").alias("length"), F.collect_set("at").alias("spots"))
    stretches = _stretches(spots.join(passages, "passage"))
    stretch = ["passage", "template", "since", "until"]
    read = stretches.select(*stretch, F.explode(F.slice("near", F.col("since") + 1, F.col("until") - F.col("since") + 1)).alias("term"))
    wf = read.groupBy(*stretch, "term").agg((1 + F.log(F.count("*"))).alias("tf")).join(idf, "term", "left")
    wf = wf.withColumn("w", F.col("tf") * F.coalesce("idf", rarest)).join(wt.select("template", "term", "share"), ["template", "term"], "left")
    scored = wf.groupBy(*stretch).agg(F.sum(F.col("w") * F.col("share")).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    scored = scored.groupBy("passage", "template").agg(F.round(F.max(F.col("dot") / F.col("norm")), 6).alias("score")).where(F.col("score") >= threshold)
    scored = scored.join(named.select("template", "license"), "template")
    best = F.min(F.struct((-F.col("score")).alias("back"), F.col("license"))).alias("b")
    judged = scored.groupBy("passage").agg(best).select("passage", "b.license", (-F.col("b.back")).alias("score"))
    best_of = links.select("evidence_key", "passage").join(judged, "passage").groupBy("evidence_key").agg(best)
    return best_of.select("evidence_key", F.col("b.license").alias("license"), (-F.col("b.back")).alias("score"))


def scan(files: DataFrame, known: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, path, license, score, origin) per row of `files` (key, path, text).

    `origin`: 'own', the directory it is inherited from, or null.
    """
    rows = files.select(F.col(key).alias("file"), F.col("path").alias("path"), F.col("text").alias("text"))
    rows = rows.select("file", "path", F.when(F.col("text").rlike(CUE), F.col("text")).alias("evidence"))
    rows = rows.withColumn("evidence_key", F.when(F.col("evidence").isNotNull(), F.xxhash64("evidence")))
    spoken = rows.where("evidence_key is not null").select("evidence_key", "evidence")
    verdicts = cut_lineage(own_licenses(spoken, known, threshold), "verdicts")
    name, directory = F.substring_index("path", "/", -1), F.regexp_replace("path", "/?[^/]*$", "")
    thin = rows.select("file", "path", directory.alias("directory"), name.alias("name"), "evidence_key")
    judged = cut_lineage(thin.join(verdicts, "evidence_key", "left").drop("evidence_key"), "judged")
    holders = (
        judged.where(F.col("license").isNotNull() & F.col("name").rlike(LICENSE_FILE))
        .groupBy("directory")
        .agg(F.min(F.struct((-F.col("score")).alias("back"), F.col("license"))).alias("b"))
        .select(F.col("directory").alias("ancestor"), F.col("b.license").alias("given"))
    )
    # Distinct directories only: as many rows as directories times their depth.
    places = judged.where("license is null and path is not null").select("directory").distinct()
    parts = F.split("directory", "/")
    above = places.select("directory", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("ancestor")))).alias("a")).select("directory", "a.depth", "a.ancestor")
    nearest = above.join(holders, "ancestor").groupBy("directory").agg(F.max(F.struct("depth", "ancestor", "given")).alias("n"))
    inherited = nearest.select("directory", F.col("n.ancestor").alias("ancestor"), F.col("n.given").alias("given"))
    out = judged.join(inherited, "directory", "left")
    own = F.col("license").isNotNull()
    return out.select(
        F.col("file").alias(key), "path", F.coalesce("license", "given").alias("license"), "score",
        F.when(own, F.lit("own")).when(F.col("given").isNotNull(), F.col("ancestor")).alias("origin"),
    )


def file_tree(docs: DataFrame) -> DataFrame:
    """The documents as files of a tree: source / language / two levels of folders by id.

    Every fourth id whose text speaks of a licence is a licence file, at one of the
    first three levels.
    """
    i = F.col("doc_id")
    a, b = F.concat(F.lit("a"), F.pmod(i, F.lit(16))), F.concat(F.lit("b"), F.pmod(F.shiftright(i, 4), F.lit(16)))
    level = F.pmod(F.shiftright(i, 2), F.lit(3))
    licence = (F.pmod(i, F.lit(4)) == 0) & F.col("text").rlike(CUE)
    path = F.when(
        licence, F.concat_ws("/", "source", F.when(level > 0, F.col("lang")), F.when(level > 1, a), F.concat(F.lit("LICENSE."), i))
    ).otherwise(F.concat_ws("/", "source", "lang", a, b, F.concat(F.lit("f"), i, F.lit(".txt"))))
    return docs.select("doc_id", path.alias("path"), "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(file_tree(table(spark, sf_dir, "documents")), templates(spark))
