"""The signature rules: what each licence looks like in a text of words.

Patterns are written over lower-case words with one space between them, punctuation gone: "GPL-3.0+"
is ``gpl 3 0``. ``(?: v| version)?`` and the like stand for what people write in between. Every rule
names a keyword that must be in the text before its pattern is tried.
"""

from __future__ import annotations

from typing import NamedTuple


class Signature(NamedTuple):
    label: str
    level: int
    keyword: str
    pattern: str
    base: bool = False


# Levels in order of priority, with the confidence of what they find.
TAG, GRANT, VERSIONED, NAMED, HINT = range(5)
CONFIDENCE = (1.0, 0.95, 0.85, 0.7, 0.3)

# The base phrases and their labels.
BASE = (
    Signature("mit", NAMED, "mit license", "mit license", True),
    Signature("apache", NAMED, "apache license", "apache license", True),
    Signature("gpl", NAMED, "general public license", "general public license", True),
)

# Public identifiers; each gives a rule for its tag and one for a licence address that ends in it.
SPDX = """
0bsd aal afl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0 artistic-2.0
blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear
bsd-4-clause bsl-1.0 busl-1.1 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0
cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0
cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0 ecl-2.0 efl-2.0 epl-1.0 epl-2.0
eupl-1.1 eupl-1.2 gfdl-1.2-only gfdl-1.3-only gpl-1.0-only gpl-2.0-only gpl-2.0-or-later gpl-3.0-only
gpl-3.0-or-later hpnd ipl-1.0 isc lgpl-2.0-only lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-only
lgpl-3.0-or-later lppl-1.3c mit mit-0 mpl-1.1 mpl-2.0 mpl-2.0-no-copyleft-exception ms-pl ms-rl
mulanpsl-2.0 ncsa odbl-1.0 odc-by-1.0 ofl-1.1 osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0
python-2.0 qpl-1.0 ruby sleepycat unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
""".split()

VERSION = r"(?: v| version| ver| vs)?"
LATER = r"(?: or| and)?(?: any| all)? (?:later|newer)(?: versions?)?"

# label | level | keyword | pattern
HAND_WRITTEN = f"""
mit | GRANT | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | GRANT | mit license | (?:released|licensed|distributed|available|published|provided) under(?: the)?(?: terms of the)? mit license
mit | VERSIONED | mit expat | mit expat license
mit | NAMED | expat | expat license
mit | NAMED | mit licen | mit licen[sc]ed?
mit | HINT | license mit | license mit
mit-0 | VERSIONED | no attribution | mit no attribution(?: license)?
x11 | NAMED | x11 | (?:mit )?x11 licen[sc]e
isc | NAMED | isc licen | isc licen[sc]e
isc | GRANT | permission to use copy modify | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
0bsd | VERSIONED | zero clause | zero clause bsd(?: licen[sc]e)?
0bsd | VERSIONED | 0bsd | 0bsd licen[sc]e
bsd-2-clause | VERSIONED | bsd | (?:simplified|freebsd|2 clause|two clause) bsd(?: licen[sc]e)?
bsd-2-clause | VERSIONED | bsd | bsd (?:2 clause|two clause|simplified)(?: licen[sc]e)?
bsd-3-clause | VERSIONED | bsd | (?:new|revised|modified|3 clause|three clause) bsd(?: style)?(?: licen[sc]e)?
bsd-3-clause | VERSIONED | bsd | bsd (?:3 clause|three clause|new|revised)(?: licen[sc]e)?
bsd-4-clause | VERSIONED | bsd | (?:original|old|4 clause|four clause) bsd(?: licen[sc]e)?
bsd-4-clause | GRANT | all advertising materials | all advertising materials mentioning features or use of this software must display
bsd | GRANT | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | NAMED | bsd licen | bsd licen[sc]e
bsd | NAMED | bsd style | bsd style licen[sc]e
bsd | HINT | berkeley software | berkeley software distribution
apache-2.0 | GRANT | apache license | licensed under the apache license{VERSION} 2(?: 0)?
apache-2.0 | VERSIONED | apache license | apache license{VERSION} 2(?: 0)?
apache-2.0 | VERSIONED | apache 2 | apache 2(?: 0)? licen[sc]e
apache-2.0 | VERSIONED | apache software license | apache software license{VERSION} 2(?: 0)?
apache-2.0 | TAG | licenses license 2 0 | apache org licenses license 2 0
apache-1.1 | VERSIONED | apache | apache(?: software)? license{VERSION} 1 1
apache-1.0 | VERSIONED | apache | apache(?: software)? license{VERSION} 1(?: 0)?
apache | NAMED | apache software license | apache software license
apache | HINT | apache licensed | apache licensed
gpl-3.0-or-later | GRANT | general public license | general public license(?: as published by the free software foundation)?(?: either)?{VERSION} 3(?: 0)?(?: of the license)?{LATER}
gpl-2.0-or-later | GRANT | general public license | general public license(?: as published by the free software foundation)?(?: either)?{VERSION} 2(?: 0)?(?: of the license)?{LATER}
gpl-3.0 | GRANT | general public license | licensed under(?: the)?(?: terms of the)?(?: gnu)? general public license{VERSION} 3(?: 0)?
gpl-2.0 | GRANT | general public license | licensed under(?: the)?(?: terms of the)?(?: gnu)? general public license{VERSION} 2(?: 0)?
gpl-3.0 | VERSIONED | general public license | (?:gnu )?general public license{VERSION} 3(?: 0)?
gpl-2.0 | VERSIONED | general public license | (?:gnu )?general public license{VERSION} 2(?: 0)?
gpl-1.0 | VERSIONED | general public license | (?:gnu )?general public license{VERSION} 1(?: 0)?
gpl-3.0 | VERSIONED | gpl | (?:gnu )?gpl{VERSION} ?3(?: 0)?
gpl-2.0 | VERSIONED | gpl | (?:gnu )?gpl{VERSION} ?2(?: 0)?
gpl-3.0 | VERSIONED | gplv3 | gplv3
gpl-2.0 | VERSIONED | gplv2 | gplv2
gpl | NAMED | gnu general public | gnu general public licen[sc]e
gpl | NAMED | gnu gpl | gnu gpl
gpl | HINT | gpl licen | gpl licen[sc]ed?
gpl | TAG | gnu org licenses gpl | gnu org licenses gpl
lgpl-3.0 | VERSIONED | lesser general public license | (?:gnu )?lesser general public license{VERSION} 3(?: 0)?
lgpl-2.1 | VERSIONED | lesser general public license | (?:gnu )?lesser general public license{VERSION} 2 1
lgpl-2.0 | VERSIONED | library general public license | (?:gnu )?library general public license{VERSION} 2(?: 0)?
lgpl | NAMED | lesser general public license | (?:gnu )?lesser general public license
lgpl | NAMED | library general public license | (?:gnu )?library general public license
lgpl-3.0 | VERSIONED | lgpl | (?:gnu )?lgpl{VERSION} ?3(?: 0)?
lgpl-2.1 | VERSIONED | lgpl | (?:gnu )?lgpl{VERSION} ?2 1
lgpl | NAMED | gnu lgpl | gnu lgpl
agpl-3.0 | VERSIONED | affero general public license | (?:gnu )?affero general public license{VERSION} 3(?: 0)?
agpl | NAMED | affero general public license | (?:gnu )?affero general public license
agpl-3.0 | VERSIONED | agpl | (?:gnu )?agpl{VERSION} ?3(?: 0)?
agpl-3.0 | VERSIONED | agplv3 | agplv3
gfdl-1.3 | VERSIONED | free documentation license | (?:gnu )?free documentation license{VERSION} 1 3
gfdl-1.2 | VERSIONED | free documentation license | (?:gnu )?free documentation license{VERSION} 1 2
gfdl | NAMED | free documentation license | (?:gnu )?free documentation license
cc-by-nc-nd-4.0 | VERSIONED | cc by | cc by nc nd 4 0
cc-by-nc-sa-4.0 | VERSIONED | cc by | cc by nc sa 4 0
cc-by-nc-4.0 | GRANT | cc by | licensed under(?: a)?(?: creative commons)? cc by nc 4 0
cc-by-nc-4.0 | VERSIONED | cc by | cc by nc 4 0
cc-by-nd-4.0 | VERSIONED | cc by | cc by nd 4 0
cc-by-sa-4.0 | VERSIONED | cc by | cc by sa 4 0
cc-by-4.0 | VERSIONED | cc by | cc by 4 0
cc-by-nc-nd-3.0 | VERSIONED | cc by | cc by nc nd 3 0
cc-by-nc-sa-3.0 | VERSIONED | cc by | cc by nc sa 3 0
cc-by-nc-3.0 | VERSIONED | cc by | cc by nc 3 0
cc-by-sa-3.0 | VERSIONED | cc by | cc by sa 3 0
cc-by-3.0 | VERSIONED | cc by | cc by 3 0
cc-by-nc-nd | NAMED | cc by | cc by nc nd
cc-by-nc-sa | NAMED | cc by | cc by nc sa
cc-by-nc | NAMED | cc by | cc by nc
cc-by-sa | NAMED | cc by | cc by sa
cc-by | HINT | cc by | cc by
cc-by-nc-sa | NAMED | creative commons | creative commons attribution non ?commercial share ?alike
cc-by-nc-nd | NAMED | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?
cc-by-nc | NAMED | creative commons | creative commons attribution non ?commercial
cc-by-sa | NAMED | creative commons | creative commons attribution share ?alike
cc-by-nd | NAMED | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: works)?
cc-by | NAMED | creative commons | creative commons attribution
cc0-1.0 | VERSIONED | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | VERSIONED | creative commons | creative commons zero(?: v1 0)?(?: universal)?
cc | HINT | creative commons | creative commons licen[sc]e
mpl-2.0 | VERSIONED | mozilla public | mozilla public licen[sc]e{VERSION} 2(?: 0)?
mpl-1.1 | VERSIONED | mozilla public | mozilla public licen[sc]e{VERSION} 1 1
mpl | NAMED | mozilla public | mozilla public licen[sc]e
epl-2.0 | VERSIONED | eclipse public | eclipse public licen[sc]e{VERSION} 2(?: 0)?
epl-1.0 | VERSIONED | eclipse public | eclipse public licen[sc]e{VERSION} 1(?: 0)?
epl | NAMED | eclipse public | eclipse public licen[sc]e
eupl-1.2 | VERSIONED | european union public | european union public licen[sc]e{VERSION} 1 2
eupl | NAMED | european union public | european union public licen[sc]e
cddl-1.0 | VERSIONED | common development | common development and distribution licen[sc]e{VERSION} 1(?: 0)?
cddl | NAMED | common development | common development and distribution licen[sc]e
cpl-1.0 | NAMED | common public | common public licen[sc]e
artistic-2.0 | VERSIONED | artistic | artistic licen[sc]e{VERSION} 2(?: 0)?
artistic | NAMED | artistic | artistic licen[sc]e
bsl-1.0 | VERSIONED | boost software | boost software licen[sc]e{VERSION} 1(?: 0)?
bsl-1.0 | NAMED | boost software | boost software licen[sc]e
busl-1.1 | NAMED | business source | business source licen[sc]e(?:{VERSION} 1 1)?
zlib | NAMED | zlib | zlib(?: libpng)? licen[sc]e
zlib | GRANT | this software is provided as is | this software is provided as is without any express or implied warranty
unlicense | NAMED | unlicense | (?:the )?unlicense
unlicense | GRANT | free and unencumbered | free and unencumbered software released into the public domain
wtfpl | NAMED | wtfpl | wtfpl
postgresql | NAMED | postgresql | postgresql licen[sc]e
python-2.0 | NAMED | python software foundation | python software foundation licen[sc]e
ruby | NAMED | ruby licen | ruby licen[sc]e
ofl-1.1 | NAMED | open font | (?:sil )?open font licen[sc]e(?:{VERSION} 1 1)?
odbl-1.0 | NAMED | open database | open database licen[sc]e
odc-by-1.0 | NAMED | open data commons | open data commons attribution licen[sc]e
pddl-1.0 | NAMED | open data commons | open data commons public domain dedication
ms-pl | NAMED | microsoft public | microsoft public licen[sc]e
ms-rl | NAMED | microsoft reciprocal | microsoft reciprocal licen[sc]e
osl-3.0 | NAMED | open software | open software licen[sc]e
afl-3.0 | NAMED | academic free | academic free licen[sc]e
ecl-2.0 | NAMED | educational community | educational community licen[sc]e
upl-1.0 | NAMED | universal permissive | universal permissive licen[sc]e
ncsa | NAMED | university of illinois | university of illinois(?: ncsa)? open source licen[sc]e
w3c | NAMED | w3c | w3c software(?: notice)?(?: and)? licen[sc]e
public-domain | NAMED | public domain | (?:released|dedicated|placed) (?:in|into|to|in to) the public domain
public-domain | HINT | public domain | public domain dedication
proprietary | NAMED | all rights reserved | all rights reserved
proprietary | HINT | proprietary | proprietary(?: and confidential)? licen[sc]e
copyleft | HINT | copyleft | copyleft
""".strip()


def _words(identifier: str) -> str:
    return identifier.replace("-", " ").replace(".", " ")


def signatures() -> tuple[Signature, ...]:
    """All rules, the base phrases first."""
    levels = {"TAG": TAG, "GRANT": GRANT, "VERSIONED": VERSIONED, "NAMED": NAMED, "HINT": HINT}
    written = []
    for line in HAND_WRITTEN.splitlines():
        label, level, keyword, pattern = (x.strip() for x in line.split(" | ", 3))
        written.append(Signature(label, levels[level], keyword, pattern))
    tags = [
        Signature(i, TAG, "spdx", f"spdx license identifier {_words(i)}") for i in SPDX
    ]
    places = [
        Signature(i, TAG, "licenses", f"(?:spdx|opensource) org licenses? {_words(i)}") for i in SPDX
    ]
    return (*BASE, *written, *tags, *places)
