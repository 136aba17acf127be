"""What the license scan knows: families with their names, standard notices, and wordings to learn from.

All of it is fixed; training and calibration texts are made from it by rule.
"""

from __future__ import annotations

from collections.abc import Iterator

# Names of each family's licences, and SPDX identifiers.
FAMILIES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "afl": (("Academic Free License",), ("AFL-3.0",)),
    "agpl": (("GNU Affero General Public License", "GNU AGPL", "AGPLv3"), ("AGPL-3.0-only", "AGPL-3.0-or-later")),
    "apache": (("Apache License", "Apache Software License", "Apache 2.0 License"), ("Apache-2.0",)),
    "artistic": (("Artistic License", "Perl Artistic License"), ("Artistic-2.0",)),
    "blueoak": (("Blue Oak Model License",), ("BlueOak-1.0.0",)),
    "boost": (("Boost Software License",), ("BSL-1.0",)),
    "bsd": (("BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "Simplified BSD License", "New BSD License", "BSD-style license"), ("BSD-2-Clause", "BSD-3-Clause", "0BSD")),
    "business": (("Business Source License",), ("BUSL-1.1",)),
    "cc-by": (("Creative Commons Attribution License", "Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC BY 3.0"), ("CC-BY-4.0", "CC-BY-3.0")),
    "cc-by-nc": (("Creative Commons Attribution-NonCommercial License", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC BY-NC 3.0"), ("CC-BY-NC-4.0", "CC-BY-NC-3.0")),
    "cc-by-nc-nd": (("Creative Commons Attribution-NonCommercial-NoDerivatives License", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC BY-NC-ND 4.0"), ("CC-BY-NC-ND-4.0",)),
    "cc-by-nc-sa": (("Creative Commons Attribution-NonCommercial-ShareAlike License", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA 4.0"), ("CC-BY-NC-SA-4.0",)),
    "cc-by-nd": (("Creative Commons Attribution-NoDerivatives License", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"), ("CC-BY-ND-4.0",)),
    "cc-by-sa": (("Creative Commons Attribution-ShareAlike License", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC BY-SA 3.0"), ("CC-BY-SA-4.0", "CC-BY-SA-3.0")),
    "cc0": (("CC0 1.0 Universal", "Creative Commons Zero", "CC0 license"), ("CC0-1.0",)),
    "cddl": (("Common Development and Distribution License",), ("CDDL-1.0",)),
    "cecill": (("CeCILL Free Software License", "CeCILL license"), ("CECILL-2.1",)),
    "cpl": (("Common Public License",), ("CPL-1.0",)),
    "ecl": (("Educational Community License",), ("ECL-2.0",)),
    "epl": (("Eclipse Public License",), ("EPL-1.0", "EPL-2.0")),
    "eupl": (("European Union Public License",), ("EUPL-1.2",)),
    "gfdl": (("GNU Free Documentation License",), ("GFDL-1.3-or-later",)),
    "gpl": (("GNU General Public License", "GNU GPL", "GPLv2", "GPLv3", "GPL v2", "GPL v3", "GPL license"), ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later")),
    "isc": (("ISC License", "Internet Systems Consortium License"), ("ISC",)),
    "lgpl": (("GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPLv3", "LGPL license"), ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only")),
    "lppl": (("LaTeX Project Public License",), ("LPPL-1.3c",)),
    "mit": (("MIT License", "Expat License", "MIT-style license", "MIT licensed"), ("MIT",)),
    "mpl": (("Mozilla Public License",), ("MPL-1.1", "MPL-2.0")),
    "ms-pl": (("Microsoft Public License",), ("MS-PL",)),
    "mulan": (("Mulan Permissive Software License", "Mulan PSL"), ("MulanPSL-2.0",)),
    "ncsa": (("University of Illinois NCSA Open Source License", "NCSA Open Source License"), ("NCSA",)),
    "odbl": (("Open Database License", "Open Data Commons Open Database License"), ("ODbL-1.0",)),
    "ofl": (("SIL Open Font License", "Open Font License"), ("OFL-1.1",)),
    "osl": (("Open Software License",), ("OSL-3.0",)),
    "postgresql": (("PostgreSQL License",), ("PostgreSQL",)),
    "proprietary": ((), ()),
    "psf": (("Python Software Foundation License", "PSF License"), ("PSF-2.0", "Python-2.0")),
    "sspl": (("Server Side Public License",), ("SSPL-1.0",)),
    "unlicense": (("The Unlicense license",), ("Unlicense",)),
    "upl": (("Universal Permissive License",), ("UPL-1.0",)),
    "vim": (("Vim License",), ("Vim",)),
    "wtfpl": (("Do What The Fuck You Want To Public License", "WTFPL license"), ("WTFPL",)),
    "zlib": (("zlib License", "zlib/libpng License"), ("Zlib",)),
    "zpl": (("Zope Public License",), ("ZPL-2.1",)),
}

# Paragraphs of standard notices and licence texts.
NOTICES: dict[str, tuple[str, ...]] = {
    "agpl": (
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "boost": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software",),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ),
    "cddl": ("The contents of this file are subject to the terms of the Common Development and Distribution License (the License). You may not use this file except in compliance with the License.",),
    "epl": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License which accompanies this distribution",),
    "gfdl": ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "ofl": ("This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is available with a FAQ at https://scripts.sil.org/OFL",),
    "postgresql": ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted",),
    "proprietary": (
        "All rights reserved.",
        "This document is confidential and proprietary. No part may be reproduced without prior written permission.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "For more information, please refer to https://unlicense.org"),
    "wtfpl": ("This program is free software. It comes without any warranty. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License",),
    "zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ),
}

#: Wordings around a licence's name: to learn from, and others to calibrate with.
FORMS = (
    "{0}", "Licensed under the {0}.", "This work is licensed under the {0}, version 3.", "Released under the {0}.", "This project is distributed under the {0}", "License: {0}",
    "the software is available under the {0}", "SPDX-License-Identifier: {1}", "license = {1}",
)
HELD_FORMS = ("You may use this file under the terms of the {0}.", "It is covered by the {0}; see the file for details", "We publish our code under {0} v2", "Published with a {0}", "This file's SPDX-License-Identifier: {1}", "[{1}]: license")
#: Names that are no licence of the families: the unknown class learns from the first, is calibrated with the others.
FOREIGN = ("Acme", "Contoso", "Globex", "Initech", "Umbrella", "Vandelay", "Aardvark Widget", "Northwind Traders")
HELD_FOREIGN = ("Hooli", "Wonka", "Fabrikam", "Zeta Reticuli", "Tailspin Toys")
FOREIGN_KINDS = ("{0} License", "{0} Public License", "{0} Software License", "{0} Open License", "{0} Community License", "{0} Free License", "{0}-1.0")

# Ordinary sentences that use licence words; every third calibrates.
ORDINARY = (
    "Her driving license expired and the version of events changed.", "The general public may visit the free museum.", "A copy of the work was released under the title.",
    "The software was distributed with the source code and documentation.", "Permission was granted by the author to use the file.", "The conditions of the work were met without restriction.",
    "He obtained a license for the restaurant under the law.", "Public attention and international attribution of the painting.", "The foundation published terms for the program.",
    "Creative work by commons members.", "Copyright law and rights of the author are discussed.", "All persons may use the library free of charge.",
    "The notice was included in all copies of the newspaper.", "Apache is a helicopter and also a people.", "Students at MIT released a report.", "The license plate was reserved.",
    "Please modify the source and binary and redistribute.", "No part of the document is confidential.", "This library is open to the general public.", "Mozilla released a version of the browser.",
    "The following list of conditions must be retained.", "You may obtain a copy at the office.", "License.", "Copyright.", "version 2.0", "under the public domain", "The GNU animal is strictly protected.",
    "Eclipse of the sun in public view", "The boost in software sales was free of charge.", "The university of Illinois opened a new source of funds.", "Postgresql and python software run on the server side.",
    "She became a public member of the European Union.", "The artistic director has an open mind.", "The Vim of the zope community", "A font of open knowledge", "The Linux foundation met in common session.",
    "Software and documentation files are provided with the product.", "Any person can obtain the following documentation.", "Terms and conditions may apply to the general agreement.", "The rights of the public were reserved in 1990.",
    "Copies of the work may be sold.", "Redistribution of wealth and use of public funds", "The notice of permission appeared in the paper.", "Without limitation the rights of persons are protected by law.",
)


def wordings(forms: tuple[str, ...]) -> Iterator[tuple[str, str]]:
    """(family, text) of the forms around every name and identifier."""
    for family, (names, identifiers) in FAMILIES.items():
        for form in forms:
            for x in names if "{0}" in form else identifiers:
                yield family, form.format(x, x)


def foreign(names: tuple[str, ...], forms: tuple[str, ...]) -> Iterator[str]:
    for name in names:
        for kind in FOREIGN_KINDS:
            whole = kind.format(name)
            for form in forms:
                yield form.format(whole, whole.replace(" ", "-"))


def templates() -> list[tuple[str, str]]:
    """(family, text) that a prediction is compared with: names, identifier lines and notices."""
    out = [(family, name) for family, (names, _) in FAMILIES.items() for name in names]
    out += [(family, f"SPDX-License-Identifier: {x}") for family, (_, identifiers) in FAMILIES.items() for x in identifiers]
    return out + [(family, text) for family, texts in NOTICES.items() for text in texts]
