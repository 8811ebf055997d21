"""License scan: canonical digests of entire texts, hash-joined to the digests of known licences.

Canonical form: A-Z lower-cased; lines that only claim a copyright dropped
(after comment marks such as ``#``, ``//`` and ``*`` they start with "copyright",
"(c)", the copyright sign, or "all rights reserved"; wrapped text such as
"copyright holders be liable" is none, see ``NO_CLAIM``); every ASCII character that
is no letter or digit, and typographic quotes, dashes and the copyright sign, is a
space, so comment marks go; runs of spaces are one; equivalent spellings are one
(``SAME``); lines that only name a licence, as files have on top, dropped
(``TITLES``).  The digest is the SHA-256 of that, lines joined by a space, so
neither wrapping nor a title nor commenting changes it.

A document is looked up whole (``licence``), and so is each of its lines, which
finds one-line notices inside other text (``notices``).  The known table is a
DataFrame (licence, text or digest) of any size, in which
long licences are kept as the digest of their canonical form; Spark joins it by digest and broadcasts
it only if it finds it small.

Defined results: a null text, or one that is empty in canonical form, has the
digest of the empty string and no licence, and known texts that are empty in
canonical form match nothing; two licences with one digest count as the one
whose name is first; repeated rows are looked up each; the empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.llm.common import prepare, stored

# Equivalent spellings (each word on the left is read as the one on the right).
SAME = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "http": "https", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor",
    "licence": "license", "licenced": "licensed", "licences": "licenses", "licencing": "licensing", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "owner": "holder", "owners": "holders", "practise": "practice", "programme": "program",
    "realise": "realize", "recognise": "recognize", "signalling": "signaling", "sublicence": "sublicense", "sublicences": "sublicenses", "sublicenced": "sublicensed", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

# Known licence texts and one-line notices.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
)

# Lines that only name a licence, in canonical form.
TITLES = (
    "apache license", "apache license 2 0", "apache license version 2 0", "bsd 2 clause license", "bsd 3 clause license", "bsd license", "bsd zero clause license",
    "gnu general public license", "gnu lesser general public license", "gnu library general public license", "isc license", "isc license isc", "license mit",
    "mit license", "mit license mit", "mozilla public license", "mozilla public license version 2 0", "new bsd license", "simplified bsd license",
    "the 2 clause bsd license", "the 3 clause bsd license", "the bsd 2 clause license", "the bsd 3 clause license", "the bsd license", "the isc license",
    "the mit license", "the mit license mit", "the unlicense", "version 2 0 january 2004", "version 2 june 1991", "version 2 1 february 1999", "version 3 29 june 2007",
    "https www apache org licenses", "zero clause bsd",
)
# Digests of whole licences in canonical form (licence, digest); Apache-2.0 with and without its appendix,
# BSD with numbers and with bullets.
DIGESTS = (
    ("Apache-2.0", "2e349068b1767ce16c09b3a0a7df25513df42a4881a97a2a0de3ecac55c2ce0a"),
    ("Apache-2.0", "a8d79b7e8197c7f128866b38ff8cce55d84713badce0ac9a63521bbd1435fbd0"),
    ("Apache-2.0", "d9fe211089c2132237cee118e2f1a7a3eeee0bc0c68216c559e343102c58cd96"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "49cf0d0fa485e32b5c15753b9c8e5c55a3023a06b7a3b5dd83a6078c8b266725"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("CC0-1.0", "de4b88a2c819a4661af54f735069ed878216da8b4992b919b84afa18cfc0e54c"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "c48e48cbc82ac227dc2e4d2c01ae944ce2d71699bffd84e2933891417e4b248f"),
    ("GPL-2.0", "4cef301105e1a91750561a15ab9e3349b8fc2923bd319effc1579d583ada4edf"),
    ("GPL-3.0", "c50bb15c5f5e96b27d60ee792a7db1637c2e416eb98869999aab5af68506cd64"),
    ("LGPL-2.0", "d6f0ea2359cc09f1b4896c788056d77cd9937aecddf8f766327e93699f1a6994"),
    ("LGPL-2.1", "3a9031b9e7ef6409b67ab8beae91d682e28953f4cec40246b719f85618937804"),
    ("LGPL-3.0", "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7"),
    ("MPL-1.1", "64a49d83bd8fd7a03e3441cca62f1c189748f458c0dcc541f24fe62524b4d833"),
    ("MPL-2.0", "c7625b8590f2bd72af25ea48c9d735f0b781eb75cc74e8419c28c89cb57a87fb"),
)

_TITLES = frozenset(t.encode() for t in TITLES)
_CLAIMS = tuple(s.encode() for s in ("copyright", "(c)", "©", "all rights reserved"))
# Words after "copyright" that make a line a part of the text and no claim.
NO_CLAIM = ("act", "and", "as", "disclaimer", "for", "holder", "holders", "in", "infringement", "interest", "interests", "is", "law", "laws", "licence", "license",
            "licenses", "management", "notice", "notices", "of", "on", "or", "owner", "owners", "protection", "right", "rights", "statement", "statements", "to", "treaty")
_AFTER = re.compile(rb"copyright(?:[a-z]|[ \t]+(?:" + "|".join(NO_CLAIM).encode() + rb")(?![a-z]))")
_COMMENT = b" \t\x0b\x0c\r#*/;!<-"
# Typographic characters read as spaces.
TYPOGRAPHIC = "©‘’“”–—"
_MARKS = tuple(c.encode() for c in TYPOGRAPHIC)
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))
_ALIKE = {a.encode(): b.encode() for a, b in SAME.items()}


def canonical(line: bytes) -> bytes:
    """Canonical form of one line (empty for a copyright line and for a title)."""
    line = line.lower()
    bare = line.lstrip(_COMMENT)
    if bare.startswith(_CLAIMS) and not _AFTER.match(bare):
        return b""
    for mark in _MARKS:
        if mark in line:
            line = line.replace(mark, b" ")
    out = b" ".join([_ALIKE.get(w, w) for w in line.translate(_PLAIN).split()])
    return b"" if out in _TITLES else out


def _canonical_lines(text: bytes) -> list[bytes]:
    return [c for c in map(canonical, text.split(b"\n")) if c]


def digest(text: str) -> str:
    """Digest of a whole text in canonical form."""
    return hashlib.sha256(b" ".join(_canonical_lines(text.encode()))).hexdigest()


def known(spark: SparkSession) -> DataFrame:
    """The library's own known table (licence, text, digest): a text, or a digest of a long one."""
    return spark.createDataFrame([*((n, t, None) for n, t in KNOWN), *((n, None, h) for n, h in DIGESTS)], "licence string, text string, digest string")


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """doc_id, digest, licence, notices (sorted names, comma-joined) of every document.

    ``licences``: licence, text and, where it has one, digest (lower-case hex; of rows without a text).
    """
    prepare(docs.sparkSession)
    empty = hashlib.sha256(b"").hexdigest()
    kind = dict(docs.dtypes)["doc_id"]

    def go(batches):
        for batch in batches:
            whole, parts = [], []
            for text in pc.fill_null(batch.column("text"), ""):
                lines = _canonical_lines(text.as_buffer().to_pybytes())
                whole.append(hashlib.sha256(b" ".join(lines)).hexdigest())
                parts.append([hashlib.sha256(x).digest() for x in set(lines)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, pa.string()), pa.array(parts, pa.list_(pa.binary()))], ["id", "digest", "lines"])

    names = licences.select(F.col("licence").alias("id"), "text").mapInArrow(go, "id string, digest string, lines array<binary>")
    if "digest" in licences.columns:
        given = licences.where(F.col("text").isNull() & F.col("digest").isNotNull()).select(F.col("licence").alias("id"), "digest", F.array().cast("array<binary>").alias("lines"))
        names = names.unionByName(given)
    names = stored(names.where((F.col("digest") != empty) & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("name")), "licence-digests")
    rows = docs.select("doc_id", "text").mapInArrow(go, f"id {kind}, digest string, lines array<binary>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "licence-rows")  # row numbers are fixed by writing them
    lines = rows.select("row", F.explode("lines").alias("line")).join(names.select(F.unhex("digest").alias("line"), "name"), "line")
    notices = lines.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("notices"))
    return rows.join(names, "digest", "left").join(notices, "row", "left").select(
        F.col("id").alias("doc_id"), "digest", F.col("name").alias("licence"), F.coalesce("notices", F.lit("")).alias("notices"))
