"""Texts by which a licence is known: whole short licences, title blocks and standard headers of long ones.

A text counts only where all of ``NEEDED`` and none of ``FOREIGN`` of its licence are among its words, which
keeps apart licences that share most of their words.
"""

from __future__ import annotations

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
)
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
    "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(name: str, version: str, or_later: str, kind: str = "program") -> str:
    """Standard header of a file under a GNU licence."""
    return (
        f"This {kind} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, "
        f"{or_later} version {version} of the License, or (at your option) any later version. This {kind} is distributed in the hope that it will be useful, "
        f"but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
    )


def _verbatim(name: str, version: str, date: str) -> str:
    """Title block of the text of a GNU licence."""
    return (
        f"{name} Version {version}, {date} Copyright (C) Free Software Foundation, Inc. "
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
    )


_GPL, _LGPL, _AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"

#: Whole texts, title blocks and headers of several lines, compared with every run of as many words.
PASSAGES: list[tuple[str, str]] = [
    ("MIT", _GRANT + _MIT_WARRANTY),
    ("MIT", _GRANT),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_WARRANTY}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", f"{_ISC_GRANT}. {_ISC_WARRANTY}"),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_2 + _BSD_3),
    ("BSD-2-Clause", _BSD_2 + _BSD_WARRANTY),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of "
        "the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    ),
    ("GPL-3.0", _gnu(_GPL, "3", "either")),
    ("GPL-3.0", _verbatim(_GPL, "3", "29 June 2007")),
    ("GPL-2.0", _gnu(_GPL, "2", "either")),
    ("GPL-2.0", _verbatim(_GPL, "2", "June 1991")),
    ("LGPL-3.0", _gnu(_LGPL, "3", "either", "library")),
    ("LGPL-3.0", _verbatim(_LGPL, "3", "29 June 2007")),
    ("LGPL-2.1", _gnu(_LGPL, "2.1", "either", "library")),
    ("LGPL-2.1", _verbatim(_LGPL, "2.1", "February 1999")),
    ("AGPL-3.0", _gnu(_AGPL, "3", "either")),
    ("AGPL-3.0", _verbatim(_AGPL, "3", "19 November 2007")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "MPL-2.0",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, "
        "or owns Covered Software.",
    ),
    (
        "CC0-1.0",
        "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. DISTRIBUTION OF THIS "
        "DOCUMENT DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP.",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
]

#: Sentences by which a licence is usually declared, compared with single lines and with every run of as many words.
STATEMENTS: dict[str, str] = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "ISC": "Released under the ISC License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "Unlicense": "Released into the public domain under the Unlicense.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
}
_CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
#: Further statements.
MORE: list[tuple[str, str]] = [
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "Licensed under the ISC License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause license that can be found in the LICENSE file."),
    ("Apache-2.0", "Licensed under Apache 2.0."),
    ("GPL-3.0", "Licensed under the GPL version 3."),
    ("GPL-2.0", "Licensed under the GPL version 2."),
    ("LGPL-3.0", "Licensed under the LGPL version 3."),
    ("LGPL-2.1", "Licensed under the LGPL version 2.1."),
    ("AGPL-3.0", "Licensed under the AGPL version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", _CC.format("")),
    ("CC-BY-SA-4.0", _CC.format("-ShareAlike")),
    ("CC-BY-NC-4.0", _CC.format("-NonCommercial")),
    ("CC-BY-ND-4.0", _CC.format("-NoDerivatives")),
    ("CC-BY-NC-SA-4.0", _CC.format("-NonCommercial-ShareAlike")),
    ("CC-BY-NC-ND-4.0", _CC.format("-NonCommercial-NoDerivatives")),
]
#: Titles, which only a line of their own states.
TITLES: list[tuple[str, str]] = [
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("ISC", "ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("GPL-2.0", f"{_GPL} version 2"),
    ("GPL-3.0", f"{_GPL} version 3"),
    ("LGPL-2.1", f"{_LGPL} version 2.1"),
    ("LGPL-3.0", f"{_LGPL} version 3"),
    ("AGPL-3.0", f"{_AGPL} version 3"),
    ("CC0-1.0", "CC0 1.0 Universal"),
]

_OTHER_GNU = {"lesser", "library", "affero", "lgpl", "agpl"}
_CC_WORDS = {"nc", "nd", "sa", "noncommercial", "noderivatives", "sharealike", "noderivs"}
#: By licence: sets of words of which each must have a member in the text.
NEEDED: dict[str, list[set[str]]] = {
    "MIT": [{"mit", "substantial"}, {"license", "permission"}],
    "ISC": [{"isc", "fee"}, {"license", "appear"}],
    "0BSD": [{"fee"}, {"granted"}],
    "BSD-3-Clause": [{"bsd", "redistributions"}, {"3", "neither"}, {"clause", "endorse"}],
    "BSD-2-Clause": [{"bsd", "redistributions"}, {"2"}, {"clause", "retain"}],
    "Apache-2.0": [{"apache"}, {"2"}],
    "GPL-3.0": [{"gnu", "gpl"}, {"general", "gpl"}, {"3"}],
    "GPL-2.0": [{"gnu", "gpl"}, {"general", "gpl"}, {"2"}],
    "LGPL-3.0": [{"lesser", "lgpl"}, {"3"}],
    "LGPL-2.1": [{"lesser", "lgpl"}, {"2.1"}],
    "AGPL-3.0": [{"affero", "agpl"}, {"3"}],
    "MPL-2.0": [{"mozilla"}, {"2"}],
    "CC0-1.0": [{"cc0"}, {"1"}],
    "Unlicense": [{"unlicense", "unencumbered"}],
    "CC-BY-4.0": [{"cc", "commons"}, {"by", "attribution"}, {"4"}],
    "CC-BY-SA-4.0": [{"cc", "commons"}, {"by", "attribution"}, {"sa", "sharealike"}, {"4"}],
    "CC-BY-NC-4.0": [{"cc", "commons"}, {"by", "attribution"}, {"nc", "noncommercial"}, {"4"}],
    "CC-BY-ND-4.0": [{"cc", "commons"}, {"by", "attribution"}, {"nd", "noderivatives"}, {"4"}],
    "CC-BY-NC-SA-4.0": [{"cc", "commons"}, {"by", "attribution"}, {"nc", "noncommercial"}, {"sa", "sharealike"}, {"4"}],
    "CC-BY-NC-ND-4.0": [{"cc", "commons"}, {"by", "attribution"}, {"nc", "noncommercial"}, {"nd", "noderivatives"}, {"4"}],
}
#: By licence: words that its text cannot have.
FOREIGN: dict[str, set[str]] = {
    "0BSD": {"appear"},
    "BSD-3-Clause": {"advertising"},
    "BSD-2-Clause": {"neither", "endorse", "advertising"},
    "GPL-3.0": _OTHER_GNU,
    "GPL-2.0": _OTHER_GNU,
    "LGPL-3.0": {"affero"},
    "LGPL-2.1": {"affero"},
    "CC-BY-4.0": _CC_WORDS,
    "CC-BY-SA-4.0": _CC_WORDS - {"sa", "sharealike"},
    "CC-BY-NC-4.0": _CC_WORDS - {"nc", "noncommercial"},
    "CC-BY-ND-4.0": _CC_WORDS - {"nd", "noderivatives"},
    "CC-BY-NC-SA-4.0": {"nd", "noderivatives", "noderivs"},
    "CC-BY-NC-ND-4.0": {"sa", "sharealike"},
}

# Identifiers of usual licences in the SPDX list, without a suffix for later versions.
SPDX_IDS = (
    "0BSD", "AFL-2.1", "AFL-3.0", "AGPL-1.0", "AGPL-3.0", "Apache-1.0", "Apache-1.1", "Apache-2.0", "APSL-2.0", "Artistic-1.0",
    "Artistic-2.0", "BlueOak-1.0.0", "BSD-1-Clause", "BSD-2-Clause", "BSD-2-Clause-Patent", "BSD-3-Clause", "BSD-3-Clause-Clear",
    "BSD-3-Clause-LBNL", "BSD-4-Clause", "BSD-Source-Code", "BSL-1.0", "BUSL-1.1", "bzip2-1.0.6", "CC-BY-1.0", "CC-BY-2.0",
    "CC-BY-2.5", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-1.0", "CC-BY-NC-2.0", "CC-BY-NC-2.5", "CC-BY-NC-3.0", "CC-BY-NC-4.0",
    "CC-BY-NC-ND-2.0", "CC-BY-NC-ND-2.5", "CC-BY-NC-ND-3.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-2.0", "CC-BY-NC-SA-2.5",
    "CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-2.0", "CC-BY-ND-2.5", "CC-BY-ND-3.0", "CC-BY-ND-4.0", "CC-BY-SA-1.0",
    "CC-BY-SA-2.0", "CC-BY-SA-2.5", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC-PDDC", "CC0-1.0", "CDDL-1.0", "CDDL-1.1", "CDLA-Permissive-1.0",
    "CDLA-Permissive-2.0", "CDLA-Sharing-1.0", "CECILL-2.0", "CECILL-2.1", "CECILL-B", "CECILL-C", "CPAL-1.0", "CPL-1.0", "curl",
    "ECL-2.0", "EFL-2.0", "Elastic-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "FSFAP", "FTL", "GFDL-1.1", "GFDL-1.2",
    "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "HPND", "ICU", "IJG", "ImageMagick", "IPL-1.0", "ISC", "JSON", "LGPL-2.0", "LGPL-2.1",
    "LGPL-3.0", "Libpng", "libtiff", "LPL-1.02", "LPPL-1.3c", "MirOS", "MIT", "MIT-0", "MIT-CMU", "MPL-1.0", "MPL-1.1", "MPL-2.0",
    "MPL-2.0-no-copyleft-exception", "MS-PL", "MS-RL", "MulanPSL-2.0", "NCSA", "NTP", "ODbL-1.0", "ODC-By-1.0", "OFL-1.0", "OFL-1.1",
    "OpenSSL", "OSL-2.1", "OSL-3.0", "PDDL-1.0", "PHP-3.0", "PHP-3.01", "PostgreSQL", "PSF-2.0", "Python-2.0", "QPL-1.0", "Ruby",
    "SGI-B-2.0", "SSPL-1.0", "TCL", "Unicode-3.0", "Unicode-DFS-2016", "Unlicense", "UPL-1.0", "Vim", "W3C", "WTFPL", "X11", "Zlib",
    "zlib-acknowledgement", "ZPL-2.0", "ZPL-2.1",
)
