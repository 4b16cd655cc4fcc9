"""License scans by ordered signature rules, in DataFrame operations only.

A text is lower-cased in A-Z and read as words (runs of a-z, 0-9 and everything outside ASCII).  Texts that hold none of
KEYWORDS are done: no rule can match without one.  In the others every word that some rule starts with is looked
up, the WINDOW words from there are joined by single spaces, and only the rules of that word run on them.  A match covers
whole words [start, end).

Of two detections where one interval contains the other, the one of higher priority stays, at equal priority the longer
one, at equal length the earlier rule; partly overlapping ones both stay.  Any better one counts, suppressed itself or not.
As no rule spans more than WINDOW words, a detection is compared only with those that start fewer words away.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows are reported each; ties are
settled as above, so the order of rows plays no part; other columns are kept out and may have any name; texts of any length
are read whole, in one pass without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 24  # words a rule may span
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[\p{Alnum}\P{ASCII}]+"  # the same words; Java matches it faster than the complement of the breaks

# Every match of a rule holds one of these, or cc and by as neighbouring words.
KEYWORDS = [
    "licen", "copyright", "warranty", "reserved", "domain", "permission", "redistribution", "confidential", "creative", "cc0", "advertising", "endorse", "evil", "perl", "opensource",
    "opendatacommons", "affero", "gpl", "bsd", "mpl", "epl", "cddl", "eupl", "sspl", "wtfpl", "odbl", "fdl", "ofl", "psl", "openrail", "apache", "released", "mozilla", "openssl",
]
CC_BY = r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by"

# Priority of a rule's kind, and the score of a text whose best detection is of it.
KINDS = {"tag": (5, 1.0), "notice": (4, 0.95), "text": (4, 0.9), "link": (3, 0.85), "name": (2, 0.75), "hint": (1, 0.4)}

# Signatures over normalised words: label, kind, first word, and what may follow it (v: a version's prefix).
# Rules of one label stand together; the order is the last tie-break.
_V = r"(?: version| v)?"
_LIC = r" licen[cs]e"
SIGNATURES: list[tuple[str, str, str, list[str]]] = [
    ("mit", "notice", "under", [r" the mit licen[cs]e", r" the terms of the mit licen[cs]e", r" an? mit(?: style)? licen[cs]e", r" mit licen[cs]e"]),
    ("mit", "notice", "released", [r" under the mit(?: x11)? licen[cs]e", r" under mit"]),
    ("mit", "notice", "licensed", [r" under the mit(?: x11)? licen[cs]e", r" under mit", r" mit"]),
    ("mit", "text", "permission", [r" is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"]),
    ("mit", "link", "opensource", [r" org licenses mit(?: license)?(?: php| html)?"]),
    ("mit", "name", "mit", [r" licen[cs]e", r" x11 licen[cs]e", r" expat licen[cs]e", r" licen[cs]ed"]),
    ("mit", "name", "expat", [r" licen[cs]e"]),
    ("mit-0", "name", "mit", [r" no attribution licen[cs]e", r" 0 licen[cs]e"]),
    ("mit-0", "text", "permission", [r" is hereby granted free of charge to any person obtaining a copy of this software without restriction"]),
    ("apache-2", "notice", "under", [rf" the apache licen[cs]e{_V} 2(?: 0)?", rf" the terms of the apache licen[cs]e{_V} 2(?: 0)?", rf" apache{_V} 2(?: 0)?"]),
    ("apache-2", "notice", "licensed", [rf" under the apache(?: software)? licen[cs]e{_V} 2(?: 0)?", rf" under apache(?: licen[cs]e)?{_V} 2(?: 0)?", r" to the apache software foundation asf under one or more contributor license agreements"]),
    ("apache-2", "text", "unless", [r" required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"]),
    ("apache-2", "text", "you", [r" may not use this file except in compliance with the license you may obtain a copy of the license at"]),
    ("apache-2", "link", "apache", [r" org licenses license 2 0(?: txt| html)?"]),
    ("apache-2", "name", "apache", [rf" licen[cs]e{_V} 2(?: 0)?", rf" software licen[cs]e{_V} 2(?: 0)?", rf" public licen[cs]e{_V} 2(?: 0)?", r" 2 0 licen[cs]e"]),
    ("apache-1", "name", "apache", [rf"(?: software)? licen[cs]e{_V} 1 [01]"]),
    ("apache-1", "text", "this", [r" product includes software developed by the apache (?:group|software foundation)"]),
    ("bsd-3", "text", "neither", [r" the name of .{1,90} nor the names of its contributors may be used to endorse or promote products"]),
    ("bsd-3", "name", "bsd", [r" 3 clause(?: new or revised)?(?: licen[cs]e)?", r" three clause(?: licen[cs]e)?", r" new licen[cs]e", r" revised licen[cs]e"]),
    ("bsd-3", "name", "3", [r" clause bsd(?: licen[cs]e)?"]),
    ("bsd-3", "name", "three", [r" clause bsd(?: licen[cs]e)?"]),
    ("bsd-3", "name", "new", [r" bsd licen[cs]e"]),
    ("bsd-3", "name", "modified", [r" bsd licen[cs]e"]),
    ("bsd-3", "link", "opensource", [r" org licenses bsd 3 clause"]),
    ("bsd-2", "name", "bsd", [r" 2 clause(?: simplified)?(?: licen[cs]e)?", r" two clause(?: licen[cs]e)?", r" simplified licen[cs]e"]),
    ("bsd-2", "name", "2", [r" clause bsd(?: licen[cs]e)?"]),
    ("bsd-2", "name", "simplified", [r" bsd licen[cs]e"]),
    ("bsd-2", "name", "freebsd", [r" licen[cs]e", r" copyright licen[cs]e"]),
    ("bsd-2", "link", "opensource", [r" org licenses bsd 2 clause"]),
    ("bsd-4", "text", "all", [r" advertising materials mentioning features or use of this software must display the following acknowledge?ment"]),
    ("bsd-4", "name", "bsd", [r" 4 clause(?: original or old)?(?: licen[cs]e)?", r" original licen[cs]e"]),
    ("bsd-0", "name", "zero", [r" clause bsd(?: licen[cs]e)?"]),
    ("bsd-0", "name", "0", [r" clause bsd(?: licen[cs]e)?"]),
    ("bsd", "notice", "under", [r" (?:the|a) bsd(?: style)? licen[cs]e", r" the terms of the bsd licen[cs]e"]),
    ("bsd", "text", "redistribution", [r" and use in source and binary forms with or without modification are permitted"]),
    ("bsd", "link", "opensource", [r" org licenses bsd license(?: php)?"]),
    ("bsd", "name", "bsd", [r" licen[cs]e", r" style licen[cs]e", r" licen[cs]ed"]),
    ("isc", "text", "permission", [r" to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", r" to use copy modify and distribute this software for any purpose with or without fee is hereby granted"]),
    ("isc", "name", "isc", [r" licen[cs]e", r" style licen[cs]e"]),
    ("isc", "link", "opensource", [r" org licenses isc(?: license)?(?: txt)?"]),
    ("gpl-3", "notice", "under", [rf" the(?: terms of the)? gnu general public licen[cs]e(?: as published by the free software foundation either)?{_V} 3", rf" the(?: gnu)? gpl{_V} ?3(?: 0)?", r" gplv3"]),
    ("gpl-3", "notice", "licensed", [rf" under the gnu general public licen[cs]e{_V} 3(?: 0)?", rf" under(?: the)?(?: gnu)? gpl{_V} 3(?: 0)?", r" under(?: the)? gplv3"]),
    ("gpl-3", "link", "gnu", [r" org licenses gpl 3 0(?: en)?(?: html| txt)?"]),
    ("gpl-3", "link", "opensource", [r" org licenses gpl 3 0(?: html)?"]),
    ("gpl-3", "name", "gnu", [rf" general public licen[cs]e{_V} 3(?: 0)?", rf" gpl{_V} 3(?: 0)?", r" gplv3"]),
    ("gpl-3", "name", "gpl", [r" v3(?: only| or later)?", rf"{_V} 3(?: 0)?(?: only| or later)?", rf"{_LIC}{_V} 3"]),
    ("gpl-3", "name", "gplv3", [r"(?: licen[cs]e)?"]),
    ("gpl-2", "notice", "under", [rf" the(?: terms of the)? gnu general public licen[cs]e(?: as published by the free software foundation either)?{_V} 2", rf" the(?: gnu)? gpl{_V} ?2(?: 0)?", r" gplv2"]),
    ("gpl-2", "notice", "licensed", [rf" under the gnu general public licen[cs]e{_V} 2(?: 0)?", rf" under(?: the)?(?: gnu)? gpl{_V} 2(?: 0)?", r" under(?: the)? gplv2"]),
    ("gpl-2", "link", "gnu", [r" org licenses(?: old licenses)? gpl 2 0(?: en)?(?: html| txt)?"]),
    ("gpl-2", "name", "gnu", [rf" general public licen[cs]e{_V} 2(?: 0)?", rf" gpl{_V} 2(?: 0)?", r" gplv2"]),
    ("gpl-2", "name", "gpl", [r" v2(?: only| or later)?", rf"{_V} 2(?: 0)?(?: only| or later)?", rf"{_LIC}{_V} 2"]),
    ("gpl-2", "name", "gplv2", [r"(?: licen[cs]e)?"]),
    ("gpl", "notice", "under", [r" the(?: terms of the)? gnu general public licen[cs]e", r" the(?: gnu)? gpl"]),
    ("gpl", "text", "this", [r" program is free software you can redistribute it and or modify it under the terms of the gnu general public license"]),
    ("gpl", "name", "gnu", [r" general public licen[cs]e", r" gpl", r" public licen[cs]e"]),
    ("gpl", "name", "gpl", [r" licen[cs]ed?", r" compatible"]),
    ("lgpl-3", "name", "gnu", [rf" lesser general public licen[cs]e{_V} 3(?: 0)?", r" lgplv3", rf" lgpl{_V} 3(?: 0)?"]),
    ("lgpl-3", "name", "lgpl", [r" v3(?: only| or later)?", rf"{_V} 3(?: 0)?(?: only| or later)?"]),
    ("lgpl-3", "name", "lgplv3", [r"(?: licen[cs]e)?"]),
    ("lgpl-2.1", "name", "gnu", [rf" lesser general public licen[cs]e{_V} 2 1", rf" lgpl{_V} 2 1"]),
    ("lgpl-2.1", "name", "lgpl", [rf"{_V} 2 1(?: only| or later)?"]),
    ("lgpl-2", "name", "gnu", [rf" library general public licen[cs]e(?:{_V} 2(?: 0)?)?"]),
    ("lgpl", "name", "gnu", [r" lesser general public licen[cs]e", r" lgpl"]),
    ("lgpl", "name", "lgpl", [r" licen[cs]ed?"]),
    ("lgpl", "link", "gnu", [r" org licenses lgpl(?: \w+)?(?: html| txt)?"]),
    ("agpl-3", "name", "gnu", [rf" affero general public licen[cs]e(?:{_V} 3(?: 0)?)?", r" agpl(?:v3)?(?: 3 0)?"]),
    ("agpl-3", "name", "affero", [r" general public licen[cs]e", r" gpl"]),
    ("agpl-3", "name", "agpl", [r" v3(?: only| or later)?", rf"{_V} 3(?: 0)?(?: only| or later)?", r" licen[cs]ed?"]),
    ("agpl-3", "name", "agplv3", [r"(?: licen[cs]e)?"]),
    ("agpl-3", "link", "gnu", [r" org licenses agpl(?: 3 0)?(?: en)?(?: html| txt)?"]),
    ("gfdl", "name", "gnu", [r" free documentation licen[cs]e(?: version| v)?(?: 1 [123])?", r" fdl"]),
    ("gfdl", "name", "gfdl", [r"(?: licen[cs]ed?)?"]),
    ("gfdl", "link", "gnu", [r" org (?:licenses|copyleft) fdl(?: 1 3)?(?: en)?(?: html| txt)?"]),
    ("mpl-2", "notice", "this", [r" source code form is subject to the terms of the mozilla public license"]),
    ("mpl-2", "name", "mozilla", [rf" public licen[cs]e{_V} 2(?: 0)?"]),
    ("mpl-2", "name", "mpl", [rf"{_V} 2(?: 0)?"]),
    ("mpl-2", "link", "mozilla", [r" org mpl 2 0", r" org en us mpl 2 0"]),
    ("mpl-1", "name", "mozilla", [rf" public licen[cs]e{_V} 1 [01]"]),
    ("mpl-1", "name", "mpl", [rf"{_V} 1 [01]"]),
    ("mpl", "name", "mozilla", [r" public licen[cs]e"]),
    ("epl-2", "name", "eclipse", [rf" public licen[cs]e{_V} 2(?: 0)?"]),
    ("epl-2", "name", "epl", [rf"{_V} 2 0"]),
    ("epl-1", "name", "eclipse", [rf" public licen[cs]e{_V} 1(?: 0)?"]),
    ("epl-1", "name", "epl", [rf"{_V} 1 0"]),
    ("epl", "name", "eclipse", [r" public licen[cs]e", r" distribution licen[cs]e"]),
    ("cddl", "name", "common", [r" development and distribution licen[cs]e(?: cddl)?(?: version| v)?(?: 1 [01])?"]),
    ("cddl", "name", "cddl", [r"(?: version| v)?(?: 1 [01])?(?: licen[cs]e)?"]),
    ("cpl", "name", "common", [r" public licen[cs]e(?: version| v)?(?: 1 0)?"]),
    ("cpal", "name", "common", [r" public attribution licen[cs]e"]),
    ("ipl", "name", "ibm", [r" public licen[cs]e"]),
    ("eupl", "name", "european", [r" union public licen[cs]e(?: version| v)?(?: 1 [012])?"]),
    ("eupl", "name", "eupl", [r"(?: version| v)?(?: 1 [012])?"]),
    ("osl", "name", "open", [r" software licen[cs]e(?: version| v)?(?: [123] [01])?"]),
    ("afl", "name", "academic", [r" free licen[cs]e(?: version| v)?(?: [123] [01])?"]),
    ("artistic-2", "name", "artistic", [rf" licen[cs]e{_V} 2(?: 0)?"]),
    ("artistic", "name", "artistic", [r" licen[cs]e"]),
    ("artistic", "notice", "same", [r" terms as perl itself"]),
    ("zlib", "name", "zlib", [r" licen[cs]e", r" libpng licen[cs]e"]),
    ("zlib", "text", "this", [r" software is provided as is without any express or implied warranty in no event will the authors be held liable"]),
    ("libpng", "name", "libpng", [r" licen[cs]e"]),
    ("bsl-1", "name", "boost", [r" software licen[cs]e(?: version| v)?(?: 1 0)?"]),
    ("bsl-1", "link", "boost", [r" org license 1 0 txt"]),
    ("busl", "name", "business", [r" source licen[cs]e(?: version| v)?(?: 1 1)?"]),
    ("sspl", "name", "server", [r" side public licen[cs]e(?: version| v)?(?: 1)?"]),
    ("sspl", "name", "sspl", [r"(?: version| v)?(?: 1)?"]),
    ("elastic", "name", "elastic", [r" licen[cs]e(?: version| v)?(?: 2 0| 2)?"]),
    ("commons-clause", "name", "commons", [r" clause licen[cs]e", r" clause condition to the licen[cs]e"]),
    ("unlicense", "name", "the", [r" unlicense"]),
    ("unlicense", "link", "unlicense", [r" org"]),
    ("unlicense", "text", "this", [r" is free and unencumbered software released into the public domain"]),
    ("wtfpl", "name", "do", [r" what the fuck you want to public licen[cs]e"]),
    ("wtfpl", "name", "wtfpl", [r"(?: licen[cs]e)?"]),
    ("psf", "name", "python", [r" software foundation licen[cs]e", r" licen[cs]e(?: version| v)?(?: 2(?: 0)?)?"]),
    ("psf", "name", "psf", [r" licen[cs]e"]),
    ("php", "name", "php", [r" licen[cs]e(?: version| v)?(?: 3 0\d?)?"]),
    ("ruby", "name", "ruby", [r" licen[cs]e", r" s licen[cs]e"]),
    ("ncsa", "name", "university", [r" of illinois ncsa open source licen[cs]e", r" of illinois open source licen[cs]e"]),
    ("openssl", "name", "openssl", [r" licen[cs]e"]),
    ("openssl", "text", "this", [r" product includes software developed by the openssl project"]),
    ("x11", "name", "x11", [r" licen[cs]e", r" style licen[cs]e"]),
    ("w3c", "name", "w3c", [r" software(?: notice and)? licen[cs]e", r" document licen[cs]e"]),
    ("ofl", "name", "sil", [r" open font licen[cs]e(?: version| v)?(?: 1 [01])?"]),
    ("ofl", "name", "open", [r" font licen[cs]e(?: version| v)?(?: 1 [01])?"]),
    ("ofl", "link", "scripts", [r" sil org ofl"]),
    ("ms-pl", "name", "microsoft", [r" public licen[cs]e(?: ms pl)?"]),
    ("ms-rl", "name", "microsoft", [r" reciprocal licen[cs]e(?: ms rl)?"]),
    ("upl", "name", "universal", [r" permissive licen[cs]e(?: upl)?(?: version| v)?(?: 1 0)?"]),
    ("postgresql", "name", "postgresql", [r" licen[cs]e"]),
    ("vim", "name", "vim", [r" licen[cs]e"]),
    ("json", "text", "the", [r" software shall be used for good not evil"]),
    ("beerware", "name", "beerware", [r" licen[cs]e"]),
    ("beerware", "name", "beer", [r" ware licen[cs]e"]),
    ("mulan", "name", "mulan", [r" (?:psl|permissive software licen[cs]e)(?: version| v)?(?: ?2)?"]),
    ("cecill", "name", "cecill", [r"(?: [bc])?(?: free software)? licen[cs]e(?: agreement)?"]),
    ("openrail", "name", "openrail", [r"(?: m)?(?: licen[cs]e)?"]),
    ("openrail", "name", "responsible", [r" ai licen[cs]e"]),
    ("llama", "name", "llama", [r"(?: [234])?(?: [123])? community licen[cs]e(?: agreement)?"]),
    ("cc0", "tag", "cc0", [r" 1 0(?: universal)?(?: public domain dedication)?", r"(?: licen[cs]e)?"]),
    ("cc0", "name", "creative", [r" commons(?: cc)? zero(?: licen[cs]e)?", r" commons cc0(?: 1 0)?(?: universal)?"]),
    ("cc0", "link", "creativecommons", [r" org publicdomain zero 1 0"]),
    ("cc-by-nc-nd", "tag", "cc", [r" by nc nd(?: [1234] \d)?"]),
    ("cc-by-nc-nd", "name", "creative", [r" commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1234] \d)?"]),
    ("cc-by-nc-nd", "link", "creativecommons", [r" org licenses by nc nd(?: [1234] \d)?"]),
    ("cc-by-nc-sa", "tag", "cc", [r" by nc sa(?: [1234] \d)?"]),
    ("cc-by-nc-sa", "name", "creative", [r" commons attribution non ?commercial share ?alike(?: [1234] \d)?"]),
    ("cc-by-nc-sa", "link", "creativecommons", [r" org licenses by nc sa(?: [1234] \d)?"]),
    ("cc-by-nc", "notice", "licensed", [r" under(?: a| the)?(?: creative commons)? cc by nc(?: [1234] \d)?(?: licen[cs]e)?"]),
    ("cc-by-nc", "tag", "cc", [r" by nc(?: [1234] \d)?"]),
    ("cc-by-nc", "name", "creative", [r" commons attribution non ?commercial(?: [1234] \d)?"]),
    ("cc-by-nc", "link", "creativecommons", [r" org licenses by nc(?: [1234] \d)?"]),
    ("cc-by-nd", "tag", "cc", [r" by nd(?: [1234] \d)?"]),
    ("cc-by-nd", "name", "creative", [r" commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1234] \d)?"]),
    ("cc-by-nd", "link", "creativecommons", [r" org licenses by nd(?: [1234] \d)?"]),
    ("cc-by-sa", "tag", "cc", [r" by sa(?: [1234] \d)?"]),
    ("cc-by-sa", "name", "creative", [r" commons attribution share ?alike(?: [1234] \d)?"]),
    ("cc-by-sa", "link", "creativecommons", [r" org licenses by sa(?: [1234] \d)?"]),
    ("cc-by", "tag", "cc", [r" by(?: [1234] \d)"]),
    ("cc-by", "name", "cc", [r" by(?: licen[cs]e)?"]),
    ("cc-by", "name", "creative", [r" commons attribution(?: [1234] \d)?(?: international)?(?: licen[cs]e)?"]),
    ("cc-by", "link", "creativecommons", [r" org licenses by(?: [1234] \d)?"]),
    ("cc", "name", "creative", [r" commons licen[cs]ed?", r" commons"]),
    ("cc", "link", "creativecommons", [r" org(?: licenses)?"]),
    ("odbl", "name", "open", [r" database licen[cs]e(?: odbl)?(?: version| v)?(?: 1 0)?"]),
    ("odbl", "name", "odbl", [r"(?: licen[cs]e)?(?: version| v)?(?: 1 0)?"]),
    ("odbl", "link", "opendatacommons", [r" org licenses odbl(?: 1 0)?"]),
    ("odc-by", "name", "open", [r" data commons attribution licen[cs]e"]),
    ("odc-by", "link", "opendatacommons", [r" org licenses by(?: 1 0)?"]),
    ("pddl", "name", "public", [r" domain dedication and licen[cs]e(?: pddl)?"]),
    ("pddl", "link", "opendatacommons", [r" org licenses pddl(?: 1 0)?"]),
    ("ogl-uk", "name", "open", [r" government licen[cs]e(?: version| v)?(?: [123](?: 0)?)?"]),
    ("kogl", "name", "korea", [r" open government licen[cs]e"]),
    ("public-domain", "notice", "released", [r" into the public domain", r" to the public domain"]),
    ("public-domain", "notice", "dedicated", [r" to the public domain"]),
    ("public-domain", "notice", "in", [r" the public domain"]),
    ("public-domain", "name", "public", [r" domain dedication", r" domain mark", r" domain"]),
    ("proprietary", "notice", "all", [r" rights reserved"]),
    ("proprietary", "notice", "proprietary", [r" and confidential", r" licen[cs]e", r" software licen[cs]e agreement"]),
    ("proprietary", "notice", "end", [r" user licen[cs]e agreement"]),
    ("proprietary", "notice", "commercial", [r" licen[cs]e(?: agreement)?"]),
    ("copyright", "hint", "copyright", [r" (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*", r" c", r" \w+ (?:19|20)\d\d"]),
    ("warranty", "hint", "without", [r" warranty of any kind", r" any warranty"]),
    ("warranty", "hint", "provided", [r" as is without warranty", r" on an as is basis without any warranty"]),
    ("unknown", "hint", "licensed", [r" under(?: the| a| an)? \w+(?: \w+)? licen[cs]e", r" under the terms of"]),
    ("unknown", "hint", "released", [r" under(?: the| a| an)? \w+(?: \w+)? licen[cs]e"]),
    ("unknown", "hint", "distributed", [r" under(?: the| a| an)? \w+(?: \w+)? licen[cs]e"]),
    ("unknown", "hint", "see", [r" the licen[cs]e file", r" licen[cs]e(?: txt| md)? for (?:more )?(?:details|information)"]),
    ("unknown", "hint", "license", [r" agreement", r" terms"]),
]

# Identifiers after "spdx license identifier", word by word, with their label.
_TAGS = {
    "mit": "mit", "mit 0": "mit-0", "apache 2 0": "apache-2", "apache 1 1": "apache-1", "bsd 3 clause": "bsd-3", "bsd 2 clause": "bsd-2", "0bsd": "bsd-0", "isc": "isc",
    "gpl 3 0": "gpl-3", "gpl 2 0": "gpl-2", "lgpl 3 0": "lgpl-3", "lgpl 2 1": "lgpl-2.1", "agpl 3 0": "agpl-3", "mpl 2 0": "mpl-2", "epl 2 0": "epl-2", "epl 1 0": "epl-1",
    "cddl 1 0": "cddl", "eupl 1 2": "eupl", "artistic 2 0": "artistic-2", "zlib": "zlib", "bsl 1 0": "bsl-1", "busl 1 1": "busl", "sspl 1 0": "sspl", "unlicense": "unlicense",
    "wtfpl": "wtfpl", "psf 2 0": "psf", "ncsa": "ncsa", "openssl": "openssl", "ofl 1 1": "ofl", "ms pl": "ms-pl", "upl 1 0": "upl", "postgresql": "postgresql", "cc0 1 0": "cc0",
    "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc", "cc by nd 4 0": "cc-by-nd", "cc by nc sa 4 0": "cc-by-nc-sa", "cc by nc nd 4 0": "cc-by-nc-nd", "odbl 1 0": "odbl",
}


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """(order, label, first word, pattern anchored at it, priority, score), one row for each signature."""
    rows = [("tag", label, "spdx", rf" licen[cs]e identifier {tag}(?: only| or later)?") for tag, label in _TAGS.items()]
    rows += [(kind, label, word, rest) for label, kind, word, each in SIGNATURES for rest in each]
    return [(n, label, word, rf"^{word}{rest}(?: |$)", *KINDS[kind]) for n, (kind, label, word, rest) in enumerate(rows)]


def gate(low: Column) -> Column:
    """Whether a lower-cased text may hold a match or a base place."""
    return reduce(lambda a, b: a | b, [low.contains(k) for k in KEYWORDS]) | (low.contains("cc") & low.rlike(CC_BY))


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, BREAKS), lambda w: w != "")


def _indexes(words: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: i < F.size(words))


def base_places(words: Column, label: str, phrase: str) -> Column:
    """Places where the phrase's words stand consecutively: array of structs (start, label)."""
    want = phrase.split(" ")
    here = lambda i: reduce(lambda a, b: a & b, [F.coalesce(F.get(words, i + k) == w, F.lit(False)) for k, w in enumerate(want)])
    return F.transform(F.filter(_indexes(words), here), lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))


def windows(words: Column) -> Column:
    """The places where some rule's first word stands: array of structs (at, word, text of the WINDOW words from there)."""
    first_words = F.array(*[F.lit(w) for w in dict.fromkeys(rule[2] for rule in rules())])
    places = F.filter(_indexes(words), lambda i: F.array_contains(first_words, F.get(words, i)))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.get(words, i).alias("word"), F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("text")))


def detections(column: str) -> Column:
    """Matches of all rules by place, in order, from a column of windows: array of arrays of structs (start, stop, rank, label, score).

    Places without a match are left out.  Written as one SQL expression, which is parsed at once.
    """
    by_word: dict[str, list[str]] = {}
    for order, label, word, pattern, priority, score in rules():
        words = f"size(split(rtrim(regexp_extract(p.text, r'{pattern}', 0)), ' '))"
        rank = f"named_struct('priority', {-priority}, 'words', -{words}, 'order', {order})"
        found = f"named_struct('start', p.at, 'stop', p.at + {words}, 'rank', {rank}, 'label', '{label}', 'score', {score}D)"
        by_word.setdefault(word, []).append(f"CASE WHEN p.text RLIKE r'{pattern}' THEN {found} END")
    cases = " ".join(f"WHEN '{word}' THEN array({', '.join(each)})" for word, each in by_word.items())
    return F.expr(f"filter(transform({column}, p -> filter(CASE p.word {cases} END, d -> d IS NOT NULL)), found -> size(found) > 0)")


def surviving(places: Column) -> Column:
    """What priority and containment leave of the detections: array of structs as above."""

    def better(other: Column, own: Column) -> Column:
        holds = (other["start"] <= own["start"]) & (other["stop"] >= own["stop"])
        held = (own["start"] <= other["start"]) & (own["stop"] >= other["stop"])
        return (holds | held) & (other["rank"] < own["rank"])

    def at(found: Column, k: Column) -> Column:
        near = F.flatten(F.slice(places, F.greatest(k + 2 - WINDOW, F.lit(1)), 2 * WINDOW - 1))
        return F.filter(found, lambda own: ~F.exists(near, lambda other: better(other, own)))

    return F.flatten(F.transform(places, at))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    The base places are those of BASE, all counted; first_word and last_word are their least and greatest start.  labels holds
    the base's and the rules' labels; score is the highest of the surviving detections' kinds, 1 where there is a base place.
    detections: array of structs (start, stop, label, score) in words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.select("id", "text", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.lower(text).alias("low"))
    rows = rows.select("id", "n_words", F.when(gate(F.col("low")), words_of(F.col("text"))).alias("words"))
    words = F.col("words")
    rows = rows.select("id", "n_words", F.concat(*[base_places(words, label, phrase) for label, phrase in BASE]).alias("base"), windows(words).alias("windows"))
    rows = rows.select("id", "n_words", "base", detections("windows").alias("places"))
    rows = rows.select("id", "n_words", "base", surviving(F.col("places")).alias("kept"))
    none = F.array().cast("array<string>")
    base = F.coalesce(F.transform("base", lambda b: b["label"]), none)
    found = F.coalesce(F.transform("kept", lambda d: d["label"]), none)
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    starts = F.transform("base", lambda b: b["start"])
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, found)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("kept", lambda d: d["score"])), F.lit(0.0))).alias("score"),
        F.coalesce(F.transform("kept", lambda d: F.struct(d["start"].alias("start"), d["stop"].alias("stop"), d["label"].alias("label"), d["score"].alias("score"))), F.array().cast("array<struct<start:int,stop:int,label:string,score:double>>")).alias("detections"),
    )


def sql() -> str:
    """The same scan in DuckDB's SQL, without the keyword gate, and with all pairs of a text's detections compared."""
    values = ", ".join(f"({order}, '{label}', '{word}', '{pattern}', {priority}, {score}::DOUBLE)" for order, label, word, pattern, priority, score in rules())
    phrases = ", ".join(f"('{label}', {phrase.split(' ')!r})" for label, phrase in BASE)
    return rf"""
WITH rule(ord, label, word, pattern, priority, score) AS (VALUES {values}), phrase(label, want) AS (VALUES {phrases}),
texts AS (
  SELECT row_number() OVER () AS n, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BREAKS}'), lambda w: w <> '') AS w
  FROM documents
), places AS (
  SELECT n, unnest(range(0, len(w))) AS i, unnest(w) AS word FROM texts
), base AS (
  SELECT n, count(*)::BIGINT AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM places JOIN phrase ON word = want[1] JOIN texts USING (n) WHERE w[i + 1 : i + len(want)] = want GROUP BY n
), hits AS (
  SELECT n, i AS start, ord, label, priority, score, rtrim(regexp_extract(array_to_string(w[i + 1 : i + {WINDOW}], ' '), pattern)) AS hit FROM places JOIN rule USING (word) JOIN texts USING (n)
), found AS (
  SELECT *, start + len(string_split(hit, ' ')) AS stop FROM hits WHERE hit <> ''
), kept AS (
  SELECT n, list(DISTINCT label) AS labels, max(score) AS score FROM found a WHERE NOT EXISTS (
    SELECT 1 FROM found b WHERE a.n = b.n AND (b.start <= a.start AND b.stop >= a.stop OR a.start <= b.start AND a.stop >= b.stop)
      AND (b.priority > a.priority OR b.priority = a.priority AND (b.stop - b.start > a.stop - a.start OR b.stop - b.start = a.stop - a.start AND b.ord < a.ord))
  ) GROUP BY n
)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, k.labels))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(k.score, 0) END::DOUBLE AS score
FROM texts t LEFT JOIN base b USING (n) LEFT JOIN kept k USING (n)
"""
