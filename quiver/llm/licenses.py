"""Licence scan by canonical digest lookup.

A text is brought to a canonical form - lower case, no copyright or "all
rights reserved" lines, no list numbers at line starts, one spelling of each
equivalent word, runs of anything but letters and digits as one space - and its SHA-256 is looked up among the digests of known licence
texts. Entire texts are compared: a document matches if it is a licence, not
if it mentions one or holds one among other text. The known texts are the
files of ``license_texts`` (named by SPDX id, one full text each) and the
short ones below, each with its usual titles, with and without its appendix,
with the usual addresses, and with its lines joined. Known texts take the same path, so any text can be added
to the list. The list is a table of the caller's; it is broadcast while it
has at most ``MAX_BROADCAST`` rows and else joined by shuffle.

Defined cases: null and empty texts, and texts of copyright lines only, have
the digest of the empty form and match nothing; known texts of equal form
count once, under their first name; repeated rows are looked up alike; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST = 100_000

# Equivalent spellings, each to the first form.
SPELLINGS = {
    "license": "licence", "licenses": "licences", "licensed": "licenced", "licensing": "licencing",
    "sublicense": "sublicence|sub licence|sub license", "organization": "organisation",
    "authorization": "authorisation", "merchantability": "merchantibility", "noninfringement": "non infringement",
    "http": "https", "percent": "per cent", "copyright holder": "copyright owner", "fulfill": "fulfil", "favor": "favour",
    "initialize": "initialise", "recognize": "recognise", "whilst": "while", "acknowledgment": "acknowledgement",
}
# A line of the text proper may begin with "copyright" too, as in "copyright notice",
# and "(c)" without a year is a list letter.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b(?!\s+(?:notices?|holders?|owners?|laws?|licen[cs]es?|and|or|in|on|is|to|for|as|"
    r"claims?|treat(?:y|ies)|protection|permission|restrictions?|disclaimers?|interest|statements?|resulting)\b)[^\n]*"
    r"|(?:©|\(c\)(?=[^\n]*\d{4}|\s*copyright\b|\s*[\[<{]))[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)$"
)
LIST_NUMBER = r"(?m)^[ \t]*\(?(?:\d{1,2}|[a-z])[.)][ \t]+"
OTHER = r"[^\p{L}\p{N}]+"

# Texts of public licences.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_ISC_TAIL = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n"
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
SHORT = [
    ("MIT", _MIT_GRANT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TAIL),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n" + _ISC_TAIL),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use "
             "this software for any purpose, including commercial applications, and to alter it and redistribute it "
             "freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; "
             "you must not claim that you wrote the original software. If you use this software in a product, an "
             "acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source "
             "versions must be plainly marked as such, and must not be misrepresented as being the original software.\n"
             "3. This notice may not be removed or altered from any source distribution."),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT notice", "Released under the MIT License."),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
]
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "BSD Zero-Clause License (0BSD)", "0BSD"],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License",
        "Simplified BSD License", "The 2-Clause BSD License", "BSD License",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License",
        "New BSD License", "Modified BSD License", "The 3-Clause BSD License", "BSD License",
    ],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License", "zlib/libpng license"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
# Notices inside the full texts: licence, first and last words.
_NOTICES = [
    ("Apache-2.0", r"Licensed under the Apache License, Version 2\.0 \(the.*?limitations under the License\."),
    ("GPL-2.0", r"This program is free software; you can redistribute.*?02110-1301 USA\."),
    ("GPL-3.0", r"This program is free software: you can redistribute.*?licenses/>\."),
    ("LGPL-2.1", r"This library is free software; you can redistribute.*?02110-1301  USA"),
    ("MPL-2.0", r"This Source Code Form is subject to the terms.*?MPL/2\.0/\."),
]
_END = re.compile(r"[ \t]*END OF TERMS AND CONDITIONS[ \t]*\n")
_ADDRESS = re.compile(r"51 Franklin St(?:reet)?,\s+Fifth\s+Floor,\s+Boston,?\s+MA\s+02110-1301,?\s+USA")
_ADDRESSES = ["59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA"]


def known_texts() -> list[tuple[str, str]]:
    """``(license, text)`` of every known text in its usual forms."""
    full = {f.name[:-4]: f.read_text("utf-8") for f in files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")}
    texts = SHORT + list(full.items())
    for name, notice in _NOTICES:
        texts.append((f"{name} notice", re.search(notice, full[name], re.S).group()))
    for name, text in full.items():
        if end := _END.search(text):
            texts += [(name, text[:end.start()]), (name, text[:end.end()])]
    texts += [(name, f"{title}\n{text}") for name, text in texts for title in TITLES.get(name, ())]
    texts += [(name, _ADDRESS.sub(a, text)) for name, text in texts if _ADDRESS.search(text) for a in _ADDRESSES]
    # List numbers and copyright lines are only seen at line starts.
    return texts + [(name, " ".join(text.split())) for name, text in texts]


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    # Lines end in \n only, so that "line" means the same everywhere.
    out = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\r", "\n")
    out = F.regexp_replace(out, COPYRIGHT_LINE, " ")
    out = F.regexp_replace(out, LIST_NUMBER, " ")
    out = F.concat(F.lit(" "), F.regexp_replace(out, OTHER, " "), F.lit(" "))
    # One pass finds the few texts that hold any variant spelling.
    variants = "|".join(SPELLINGS.values())
    spelled = out
    for to, forms in SPELLINGS.items():
        spelled = F.regexp_replace(spelled, rf"\b(?:{forms})(s?)\b", f"{to}$1")
    return F.trim(F.when(out.rlike(rf"\b(?:{variants})s?\b"), spelled).otherwise(out))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(doc_id, digest, license)`` per document; ``license`` is null where
    the text is none of ``known (license, text)``."""
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame(known_texts(), "license string, text string")
    form = canonical(F.col("text"))
    listed = known.select("license", form.alias("form")).where("form <> ''").groupBy(
        F.sha2("form", 256).alias("digest")
    ).agg(F.min("license").alias("license"))
    rows = docs.select("doc_id", F.sha2(form, 256).alias("digest"))
    few = listed.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    return rows.join(F.broadcast(listed) if few else listed, "digest", "left").select("doc_id", "digest", "license")
