"""License scans by template-markup matching.

A template is wording with markup: ``<<beginOptional>> ... <<endOptional>>``
around words that may be left out, and ``<<var;max=N>>`` for up to N words of
any kind. It is compiled into an automaton over words; a passage is accepted
when all mandatory words stand exactly as given. Passages may begin anywhere:
a template starts with mandatory words, those are searched at the speed of
bytes, and the automaton runs from each place found, so a text costs its
length plus a template's length for each such place.

Base labels come from fixed phrases. The labels of accepted templates join
them. ``score`` is the share of a text's words that lie in phrases or accepted
passages.

Defined cases: null and empty texts have no words and no labels, score 0;
overlapping passages count their words once; repeated rows are judged alike;
empty input gives empty output.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywise.llm.common import with_text_columns

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public license wording with markup.
_FSF = ("redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation <<beginOptional>>either<<endOptional>> version {} <<beginOptional>>of the license<<endOptional>> "
        "<<beginOptional>>or at your option any later version<<endOptional>> <<beginOptional>><<var;max=6>> distributed in the hope that "
        "it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular "
        "purpose see the gnu general public license for more details<<endOptional>> <<beginOptional>>you should have received a copy of "
        "the gnu general public license along with <<var;max=4>> <<beginOptional>>if not <<var;max=20>><<endOptional>><<endOptional>>")
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met <<beginOptional>>1<<endOptional>> redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer <<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce "
        "the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution {}this software is provided by <<var;max=12>> as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in "
        "no event shall <<var;max=12>> be liable for any direct indirect incidental special exemplary or consequential damages including "
        "but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however "
        "caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising "
        "in any way out of the use of this software even if advised of the possibility of such damage")
_ENDORSE = ("<<beginOptional>>3<<endOptional>> neither the name of <<var;max=12>> nor the names of <<var;max=3>> contributors may be used to "
            "endorse or promote products derived from this software without specific prior written permission ")
_CC = " ".join(f"<<beginOptional>>{v} <<var;max=3>><<endOptional>>" for v in ("4 0", "3 0", "2 5", "2 1", "2 0", "1 0"))
TEMPLATES = {
    "mit-notice": "<<beginOptional>>this software is<<endOptional>> released under the <<beginOptional>>terms of the<<endOptional>> MIT license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                "documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction "
                "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                "copies of the software and to permit persons to whom the software is furnished to do so subject to the following "
                "conditions the above copyright notice and this permission notice <<beginOptional>>including the next "
                "paragraph<<endOptional>> shall be included in all copies or substantial portions of the software the software is "
                "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
                "merchantability fitness for a particular purpose and noninfringement in no event shall <<var;max=12>> be liable for "
                "any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
                "connection with the software or the use or other dealings in the software",
    "apache-2.0-notice": "licensed under the apache license version 2 <<beginOptional>>0<<endOptional>> "
                         "<<beginOptional>>the license you may not use <<var;max=4>> except in compliance with the license<<endOptional>> "
                         "<<beginOptional>>you may obtain a copy of the license at <<var;max=10>> unless required by applicable law or "
                         "agreed to in writing software distributed under the license is distributed on an as is basis without "
                         "warranties or conditions of any kind either express or implied see the license for the specific language "
                         "governing permissions and limitations under the license<<endOptional>>",
    "gpl-3.0-notice": "licensed under the <<beginOptional>>terms of the<<endOptional>> gnu general public license "
                      "<<beginOptional>>as published by the free software foundation either<<endOptional>> version 3",
    "gpl-2.0-notice": "licensed under the <<beginOptional>>terms of the<<endOptional>> gnu general public license "
                      "<<beginOptional>>as published by the free software foundation either<<endOptional>> version 2",
    "gpl-3.0-fsf-notice": _FSF.format(3),
    "gpl-2.0-fsf-notice": _FSF.format(2),
    "bsd-2-clause-text": _BSD.format(""),
    "bsd-3-clause-text": _BSD.format(_ENDORSE),
    "isc-text": "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose "
                "with or without fee is hereby granted provided that the above copyright notice and this permission notice "
                "appear in all copies the software is provided as is and <<var;max=8>> disclaims all warranties with regard to this "
                "software including all implied warranties of merchantability and fitness in no event shall <<var;max=8>> be liable "
                "for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
                "profits whether in an action of contract negligence or other tortious action arising out of or in connection with the "
                "use or performance of this software",
    "cc-by-notice": "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> creative commons attribution "
                    + _CC + " license",
    "mpl-2.0-notice": "subject to the terms of the mozilla public license v 2 0",
}

MARKUP = re.compile(r"<<(beginOptional|endOptional|var;max=(\d+))>>")
_BLANK = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters a-z and all beyond ASCII."""
    return text.encode().translate(_BLANK).split()


class Template:
    """An automaton over words. State 0 follows the mandatory opening (``lead``);
    ``edges[s]`` lists (word or None for any word, next), ``free[s]`` the states reached without a word."""

    def __init__(self, wording: str):
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        parts = MARKUP.split(wording)
        state, opened, begun = 0, [], False
        lead: list[bytes] = []
        for k in range(0, len(parts), 3):
            for w in words_of(parts[k]):
                if opened and not begun:
                    continue  # optional words before the mandatory opening decide nothing
                if not begun:
                    lead.append(w)
                    continue
                state = self._step(state, w)
            if k + 1 >= len(parts):
                break
            mark, most = parts[k + 1], parts[k + 2]
            if lead and mark != "endOptional":
                begun = True
            if mark == "beginOptional":
                opened.append(state if begun else None)
            elif mark == "endOptional":
                start = opened.pop()
                if start is not None:
                    end = self._new()
                    self.free[state].append(end)
                    self.free[start].append(end)
                    state = end
            elif begun:
                ends = [state]
                for _ in range(int(most)):
                    state = self._step(state, None)
                    ends.append(state)
                end = self._new()
                for s in ends:
                    self.free[s].append(end)
                state = end
        if not lead:
            raise ValueError("a template needs mandatory words before its last markup")
        self.lead, self.final = lead, state
        self.needle = b" " + b" ".join(lead) + b" "
        self.closure = [self._reach(s) for s in range(len(self.edges))]

    def _new(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def _step(self, state: int, word: bytes | None) -> int:
        to = self._new()
        self.edges[state].append((word, to))
        return to

    def _reach(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def accept(self, words: list[bytes], at: int) -> int | None:
        """Past-last position of the longest passage whose opening ends before word ``at``."""
        live, end = set(self.closure[0]), None
        while True:
            if self.final in live:
                end = at
            if at >= len(words) or not live:
                return end
            word, now = words[at], set()
            for s in live:
                for w, t in self.edges[s]:
                    if w is None or w == word:
                        now |= self.closure[t]
            live, at = now, at + 1


COMPILED: dict[str, Template] = {}


def compiled() -> dict[str, Template]:
    if not COMPILED:
        COMPILED.update({name: Template(t) for name, t in TEMPLATES.items()})
    return COMPILED


def places(joined: bytes, needle: bytes) -> list[int]:
    """Word positions at which the words of ``needle`` (with blanks around) stand in ``joined``."""
    out, at, word, seen = [], joined.find(needle), 0, 0
    while at >= 0:
        word += joined.count(b" ", seen, at)
        seen = at
        out.append(word)
        at = joined.find(needle, at + 1)
    return out


def scan(text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = words_of(text)
    if not words:
        return 0, 0, None, None, "", "", 0.0
    joined = b" " + b" ".join(words) + b" "
    starts, base, more, spans = [], set(), set(), []
    for phrase, label in PHRASES:
        found = places(joined, b" " + phrase.encode() + b" ")
        if found:
            base.add(label)
            starts += found
            n = phrase.count(" ") + 1
            spans += [(a, a + n) for a in found]
    for label, template in compiled().items():
        for a in places(joined, template.needle):
            end = template.accept(words, a + len(template.lead))
            if end is not None:
                more.add(label)
                spans.append((a, end))
    covered, upto = 0, 0
    for a, b in sorted(spans):
        covered += max(0, b - max(a, upto))
        upto = max(upto, b)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | more)), covered / len(words))


FIELDS = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
          ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType())]


def with_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    def run(texts):
        rows = [scan(t) for t in texts]
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in FIELDS]

    return with_text_columns(df, text, FIELDS, run)
