"""Licence scans in DataFrame functions only.

Every sentence and every line of a whole file is compared with the notices of public
licences by the cosine of sparse TF-IDF vectors of their words; the best one is the file's
own licence.  A file that is as a whole like the text of a licence is a licence file: it
speaks for its directory.  Files without a licence of their own take that of the nearest
ancestor directory with a licence file, found by joining paths.

Before any word is exploded, texts go by bounds that no match falls short of: a text has
to have one of the telling words without which a template can't reach the least cosine,
and as many of its words as that takes at least.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cowrie.session import shared_folder

# Short names of public licences, the notices that files quote them by, and
# the texts of licence files.
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:"
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_CONDITIONS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License."
)
_APACHE_REST = (
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
    'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License."
)
_GPL_REST = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
    "details. You should have received a copy of the GNU General Public License along with this program."
)


def _gpl_notice(version: int) -> str:
    return (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        f"Public License as published by the Free Software Foundation, either version {version} of the License, or (at "
        "your option) any later version."
    )


NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", _BSD_GRANT),
    ("BSD-3-Clause", _BSD_NAMES),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _gpl_notice(2)),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _gpl_notice(3)),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("ISC", "Released under the ISC License."),
    ("ISC", _ISC_GRANT),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("MIT", "Released under the MIT License."),
    ("MIT", _MIT_GRANT),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
)
TEXTS = (
    ("Apache-2.0", f"{_APACHE_NOTICE} {_APACHE_REST}"),
    ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("GPL-2.0", f"{_gpl_notice(2)} {_GPL_REST}"),
    ("GPL-3.0", f"{_gpl_notice(3)} {_GPL_REST}"),
    ("ISC", f"{_ISC_GRANT} {_ISC_REST}"),
    ("MIT", f"{_MIT_GRANT} {_MIT_REST}"),
)
# Words of any English text: they count in no vector.
COMMON = frozenset(
    """a above all an and any are as at be but by can do either even following for from has have if in is it its may more
    must no not of on only or other out shall should such than that the their there these they this to under use was
    when whether which will with without you your""".split()
)

#: Least cosine of a sentence or line with a notice, and of a whole file with a text.
SENTENCE, WHOLE = 0.6, 0.8
#: What rounding may add to a score.
ROUNDED = 1e-4
_WORDS = "[^a-z0-9]+"
_LOWER_TO_ASCII = "\u212a\u0130"


def words_of(text: str) -> list[str]:
    words = re.split(_WORDS, text.translate({c: c + 32 for c in range(65, 91)}))
    return [w for w in words if w and w not in COMMON]


def _counted(n: int) -> float:
    """The weight of ``n`` occurrences: 1 + ln n."""
    return 1 + math.log(n)


@dataclass(frozen=True)
class Templates:
    """Texts by licence as TF-IDF vectors, frequencies being taken from these texts."""

    texts: tuple[tuple[str, str], ...]
    least: float

    @cached_property
    def idf(self) -> dict[str, float]:
        n, sets = len(self.texts), [set(words_of(t)) for _, t in self.texts]
        return {w: math.log((1 + n) / (1 + sum(w in s for s in sets))) + 1 for w in sorted(set().union(*sets))}

    @property
    def other(self) -> float:
        """The weight of a word that no template has."""
        return math.log(1 + len(self.texts)) + 1

    @cached_property
    def vectors(self) -> list[dict[str, float]]:
        """Of length 1, in the order of the texts."""
        made = []
        for _, text in self.texts:
            words = words_of(text)
            weights = {w: _counted(words.count(w)) * self.idf[w] for w in set(words)}
            norm = math.sqrt(sum(x * x for x in weights.values()))
            made.append({w: x / norm for w, x in sorted(weights.items())})
        return made

    @cached_property
    def telling(self) -> list[str]:
        """Words of which each text that reaches the least cosine has one.

        A cosine is at most the length of the template's part in the words in common.  So the
        heaviest words are taken until the length of the others is less.
        """
        found: set[str] = set()
        for vector in self.vectors:
            rest = 1.0
            for w, x in sorted(vector.items(), key=lambda i: (-i[1], i[0])):
                if rest < (self.least - ROUNDED) ** 2:
                    break
                found.add(w)
                rest -= x * x
        return sorted(found)

    @cached_property
    def fewest(self) -> list[int]:
        """How many of a template's words, the heaviest, reach the least cosine."""
        made = []
        for vector in self.vectors:
            reached, n = 0.0, 0
            for x in sorted(vector.values(), reverse=True):
                if reached >= (self.least - ROUNDED) ** 2:
                    break
                reached, n = reached + x * x, n + 1
            made.append(n)
        return made

    def tell(self, words: Column) -> Column:
        """False only for texts, as arrays of words, without a telling word."""
        return F.arrays_overlap(words, F.array(*map(F.lit, self.telling)))

    def may_match(self, words: Column) -> Column:
        """False only for texts that no template reaches the least cosine with.

        A text needs enough of a template's words.  And with ``m`` of them and ``u`` others
        that no template has, each of weight ``other`` at least, its square cosine is at most
        ``s / (s + u)`` where ``s`` is ``m`` times the square of the weight of as many
        occurrences as the text has repeated words at all.
        """
        no_words = F.array(*map(F.lit, ["", *sorted(COMMON)]))

        def enough(words: Column, own: Column) -> Column:
            # ``own``: the few of the words that any template has
            distinct = F.size(F.array_except(words, no_words))
            strange = distinct - F.size(own)
            most = F.pow(1 + F.log(F.size(words) - distinct + 1), F.lit(2.0)) * (1 / (self.least - ROUNDED) ** 2 - 1)
            reached = []
            for vector, least in zip(self.vectors, self.fewest):
                common = F.size(F.array_intersect(own, F.array(*map(F.lit, vector))))
                reached.append((common >= least) & (strange <= common * most))
            return F.size(own).between(min(self.fewest), len(self.idf)) & reduce(or_, reached)

        known = F.array(*map(F.lit, self.idf))
        return _once(words, lambda w: self.tell(w) & _once(F.array_intersect(w, known), lambda own: enough(w, own)))

    def table(self, spark: SparkSession) -> DataFrame:
        """``template, license, word, weight``: a constant of the templates' words."""
        rows = F.array(*(
            F.struct(F.lit(k).alias("template"), F.lit(self.texts[k][0]).alias("license"), F.lit(w).alias("word"), F.lit(x).alias("weight"))
            for k, vector in enumerate(self.vectors) for w, x in vector.items()
        ))
        return spark.range(1).select(F.explode(rows).alias("v")).select("v.*")

    def frequencies(self, spark: SparkSession) -> DataFrame:
        rows = F.array(*(F.struct(F.lit(w).alias("word"), F.lit(x).alias("idf")) for w, x in self.idf.items()))
        return spark.range(1).select(F.explode(rows).alias("v")).select("v.*")


def _folded(text: Column) -> Column:
    """A-Z in lower case, and so the same words as folding A-Z alone leaves.

    Other letters may change too, but they end words either way.  Only of two letters, the
    Kelvin sign and the dotted I, the lower case holds one of a-z: they go before.
    """
    for letter in _LOWER_TO_ASCII:
        text = F.replace(text, F.lit(letter), F.lit("\u00d7"))
    return F.lower(text)


def _words(folded: Column | str) -> Column:
    return F.split(folded, _WORDS)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value being computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: str) -> Column:
    """A text's sentences and lines, each once.

    A sentence ends at a point, mark or question mark before white space, unless a single
    letter stands before it, so that ``v. 2.0`` stays whole.
    """
    end = "([0-9]|[^ \t\n\r\f][^ \t\n\r\f])([.!?])[ \t\n\r\f]+"
    sentences = F.split(F.regexp_replace(text, end, "$1$2\u0001"), "\u0001")
    return F.array_distinct(F.concat(sentences, F.split(text, "\n")))


def cosines(texts: DataFrame, keys: list[str], templates: Templates) -> DataFrame:
    """``keys, license, score`` of ``texts (keys, folded)`` that share a word with a template.

    One row for each template; ``score`` is rounded to 4 digits, so that it doesn't
    depend on the order of a sum.
    """
    spark = texts.sparkSession
    words = texts.select(*keys, F.explode(_words("folded")).alias("word")).where(
        (F.col("word") != "") & ~F.col("word").isin(*sorted(COMMON))
    )
    counts = words.groupBy(*keys, "word").agg((1 + F.log(F.count(F.lit(1)))).alias("n"))
    # constants of some hundred rows
    weighed = counts.join(F.broadcast(templates.frequencies(spark)), "word", "left").withColumn(
        "value", F.col("n") * F.coalesce(F.col("idf"), F.lit(templates.other))
    )
    norms = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    shared = weighed.where(F.col("idf").isNotNull()).join(F.broadcast(templates.table(spark)), "word")
    dots = shared.groupBy(*keys, "template", "license").agg(F.sum(F.col("value") * F.col("weight")).alias("dot"))
    return dots.join(norms, keys).select(*keys, "license", F.round(F.col("dot") / F.col("norm"), 4).alias("score"))


def _best(scored: DataFrame, keys: list[str], least: float) -> DataFrame:
    """The licence with the highest score of at least ``least``, ties to the first by name."""
    best = scored.where(F.col("score") >= least).groupBy(*keys, "license").agg(F.max("score").alias("score"))
    # a row for each licence at most
    first = F.array_min(F.collect_list(F.struct((-F.col("score")).alias("s"), "license")))
    return best.groupBy(*keys).agg(first.alias("_b")).select(
        *keys, F.col("_b.license").alias("license"), (-F.col("_b.s")).alias("score")
    )


def scan(
    files: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, texts: Sequence[tuple[str, str]] = TEXTS
) -> DataFrame:
    """``doc_id, path, license, how, score, found_in`` of every row of ``files (doc_id, path, text)``.

    ``how`` is ``file`` for licence files, ``header`` for a notice inside the text,
    ``inherited`` for the licence of the nearest ancestor directory with a licence file
    (of several the one with the highest score, ties to the first name), else ``none``.
    ``found_in`` is the path of the text or directory it is from.  Null and empty texts
    have no licence of their own; a null path inherits none.  Rows are told apart by
    ``doc_id`` and ``path``; rows that repeat both take the best of their texts.  Other
    columns are ignored, empty tables give empty results.
    """
    keys = ["doc_id", "path"]
    by_notice, by_text = Templates(tuple(notices), SENTENCE), Templates(tuple(texts), WHOLE)
    rows = files.select("doc_id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    # nulls in keys would not join
    folded = _folded(F.col("text"))
    told = _written(
        rows.select(F.xxhash64(F.struct("doc_id", "path")).alias("key"), "text")
        .where(_once(_words(folded), lambda w: by_notice.tell(w) | by_text.may_match(w)))
    )
    # rows that repeat a text or a piece of it count once
    whole = told.select("key", folded.alias("folded")).where(by_text.may_match(_words("folded"))).distinct()
    whole = whole.withColumn("whole", F.xxhash64("folded"))
    pieces = told.select("key", F.explode(_pieces("text")).alias("piece")).select("key", _folded(F.col("piece")).alias("folded"))
    near = pieces.where(by_notice.may_match(_words("folded"))).distinct()
    header = _best(cosines(near.withColumn("piece", F.xxhash64("folded")), ["key", "piece"], by_notice), ["key"], SENTENCE)
    whole = _best(cosines(whole, ["key", "whole"], by_text), ["key"], WHOLE)
    own = _written(header.select("key", F.col("license").alias("h_license"), F.col("score").alias("h_score")).join(
        whole.select("key", F.col("license").alias("w_license"), F.col("score").alias("w_score")), "key", "full"
    ))
    placed = rows.select(*keys, F.xxhash64(F.struct("doc_id", "path")).alias("key"), _parent("path").alias("directory"))
    found = placed.join(own, "key", "left")

    speaking = found.where(F.col("w_license").isNotNull() & F.col("directory").isNotNull())
    of_directory = _best(
        speaking.select("directory", F.col("w_license").alias("license"), F.col("w_score").alias("score")), ["directory"], WHOLE
    )
    # one row for each directory before any path is exploded, however many files it holds
    directories = placed.select("directory").where(F.col("directory").isNotNull()).distinct()
    ancestors = directories.select("directory", F.explode(_ancestors("directory")).alias("ancestor"))
    reached = ancestors.join(of_directory.withColumnRenamed("directory", "ancestor"), "ancestor")
    nearest = reached.groupBy("directory").agg(
        F.max_by(F.struct("license", "score", "ancestor"), F.length("ancestor")).alias("_n")
    )
    inherited = nearest.select(
        "directory", F.col("_n.license").alias("i_license"), F.col("_n.score").alias("i_score"), F.col("_n.ancestor").alias("from")
    )
    out = found.join(inherited, "directory", "left")
    is_file, is_header, inherits = (F.col(c).isNotNull() for c in ("w_license", "h_license", "i_license"))
    pick = lambda a, b, c: F.when(is_file, a).when(is_header, b).when(inherits, c)
    return out.select(
        *keys,
        pick(F.col("w_license"), F.col("h_license"), F.col("i_license")).alias("license"),
        pick(F.lit("file"), F.lit("header"), F.lit("inherited")).otherwise("none").alias("how"),
        pick(F.col("w_score"), F.col("h_score"), F.col("i_score")).otherwise(0.0).alias("score"),
        pick(F.col("path"), F.col("path"), F.col("from")).alias("found_in"),
    )


def _written(rows: DataFrame) -> DataFrame:
    folder = shared_folder(rows.sparkSession, "licenses")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _parent(path: str) -> Column:
    """``a/b`` of ``a/b/c``; the empty root of a bare name."""
    return F.regexp_replace(F.col(path), "/?[^/]*$", "")


def _ancestors(directory: str) -> Column:
    """The directory itself, those above it and the root."""
    parts = F.split(F.col(directory), "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.array_distinct(F.concat(up, F.array(F.lit(""))))
