"""License notices as they stand in files, and texts that only look like them."""

import pytest

from weftline.llm import licenses

FSF = "as published by the Free Software Foundation"
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} " + FSF
BSD = (
    "Redistributions of source code must retain the above copyright notice. Redistributions in binary form must reproduce the above "
    "copyright notice in the documentation and/or other materials provided with the distribution. {}"
)
#: Text and the labels that it must have (not more than these).
NOTICES = [
    (GNU.format("General Public License") + "; either version 2 of the License, or (at your option) any later version.", "gpl-2,or-later"),
    (GNU.format("General Public License") + ", either version 3 of the License, or (at your option) any later version.", "gpl-3,or-later"),
    (GNU.format("General Public License") + ", version 2.", "gpl-2"),
    (GNU.format("General Public License") + ", version 3.", "gpl-3"),
    ("under version 2 of the GNU General Public License only", "gpl-2"),
    ("under version 3 of the GNU General Public License", "gpl-3"),
    (GNU.format("Lesser General Public License") + "; either version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1,or-later"),
    (GNU.format("Lesser General Public License") + "; either version 3 of the License, or any later version.", "lgpl-3,or-later"),
    (GNU.format("Library General Public License") + "; either version 2 of the License.", "lgpl-2"),
    (GNU.format("Lesser General Public License") + ", version 2.1.", "lgpl-2.1"),
    (GNU.format("Affero General Public License") + ", either version 3 of the License, or (at your option) any later version.", "agpl-3,or-later"),
    (GNU.format("Affero General Public License") + " version 3.", "agpl-3"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
    ("The contents of this file are subject to the Mozilla Public License Version 1.1", "mpl-1.1"),
    ("made available under the terms of the Eclipse Public License v1.0", "epl-1"),
    ("made available under the terms of the Eclipse Public License 2.0", "epl-2"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("a Creative Commons Attribution-ShareAlike 3.0 Unported License", "cc-by-sa"),
    ("a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("a Creative Commons Attribution-NoDerivatives 4.0 International License", "cc-by-nd"),
    ("a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License", "cc-by-nc-sa"),
    ("a Creative Commons Attribution-NonCommercial-NoDerivs 2.5 Generic License", "cc-by-nc-nd"),
    ("has waived all copyright and related or neighboring rights to this work", "cc0"),
    ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable", "zlib"),
    (BSD.format("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"), "bsd,bsd-2-clause"),
    (BSD.format("3. Neither the name of the copyright holder nor the names of its contributors"), "bsd,bsd-3-clause"),
    (BSD.format("All advertising materials mentioning features or use of this software must display"), "bsd,bsd-4-clause"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee", "isc"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");", "apache-2"),
    ("The Apache Software License, Version 1.1", "apache-1.1"),
    ("Distributed under the Boost Software License, Version 1.0.", "boost-1"),
    ("under the terms of the Artistic License 2.0", "artistic-2"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1.", "ofl-1.1"),
    ("under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by", "gfdl,or-later"),
    ("released under the MIT License", "mit"),
    ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", "wtfpl"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2,mit"),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT\nuse std::io", "apache-2,mit"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", "gpl-2,linux-syscall-note"),
    ("SPDX-License-Identifier: (GPL-2.0-or-later AND BSD-3-Clause)", "bsd-3-clause,gpl-2,or-later"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1,or-later"),
    ("SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception", "apache-2,llvm-exception"),
]
NOTHING = [
    "they got a boost license plate",
    "mit dem Wagen in die Stadt und mit der Bahn zurück",
    "version 2 of the story, or any later chapter",
    "the distribution of this software is provided by mail",
    "a creative person and a mozilla browser in an eclipse of the sun",
    "this license to drive was issued by the city",
    "the artistic director and the open font of knowledge",
    "without any express train, implied consent is neighboring on silence",
    "the identifier of the car: mit or apache",
    "unencumbered by doubt, advertising what you want",
]


@pytest.fixture(scope="module")
def labels(spark):
    texts = [t for t, _ in NOTICES] + [f"header lines come first\n{t}\nand code after it" for t, _ in NOTICES] + NOTHING
    return {r.text: set(r.labels.split(",")) - {""} for r in licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}


def test_notices(labels):
    wrong = {t: (sorted(labels[t]), want) for t, want in NOTICES if labels[t] != set(want.split(","))}
    assert not wrong


def test_notices_inside_a_file(labels):
    assert not {t: labels[f] for t, want in NOTICES if labels[f := f"header lines come first\n{t}\nand code after it"] != set(want.split(","))}


def test_no_notice(labels):
    assert not {t: labels[t] for t in NOTHING if labels[t]}


def test_every_rule_has_its_anchor():
    for label, anchor, pattern, priority, confidence in licenses.rules():
        assert pattern.count(rf"\|{anchor}") == 1 and 0 < confidence < 1 and priority > 0, label
