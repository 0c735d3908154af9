"""Sentences of license texts, as signature rules of the license scan.

Each is written out: label, weight, and a regular expression over normalised
words (lower-cased, punctuation gone, one space between words).
"""

from __future__ import annotations

#: label, weight, sentence.
SENTENCES = (
    ("mit", 0.9,
     r"the software is provided as is without warranty of any kind express or implied including but not "
     r"limited to the warranties of merchantability"),
    ("mit", 1.0,
     r"to deal in the software without restriction including without limitation the rights to use copy "
     r"modify merge publish distribute sublicense"),
    ("x11", 0.9,
     r"except as contained in this notice the name of .{1,80}? shall not be used in advertising or "
     r"otherwise to promote the sale use or other dealings in this software"),
    ("json", 1.0, r"the software shall be used for good not evil"),
    ("hpnd", 0.9,
     r"permission to use copy modify and distribute this software and its documentation for any purpose and"
     r" without fee is hereby granted provided that the above copyright notice appear in all copies"),
    ("apache-1.1", 0.9, r"this product includes software developed by the apache software foundation"),
    ("apache-1.1", 1.0,
     r"products derived from this software may not be called apache nor may apache appear in their name"),
    ("apache-2", 1.0, r"licensed under the apache license version 2 0 the license"),
    ("apache-2", 0.9,
     r"unless required by applicable law or agreed to in writing software distributed under the license is "
     r"distributed on an as is basis"),
    ("apache-2", 0.9,
     r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free "
     r"irrevocable copyright license"),
    ("apache-2", 0.9,
     r"work shall mean the work of authorship whether in source or object form made available under the "
     r"license"),
    ("bsd-2-clause", 0.8,
     r"redistributions of source code must retain the above copyright notice this list of conditions and "
     r"the following disclaimer"),
    ("bsd-2-clause", 0.8,
     r"redistributions in binary form must reproduce the above copyright notice this list of conditions and"
     r" the following disclaimer in the documentation"),
    ("bsd-2-clause", 0.8,
     r"this software is provided by the (?:copyright holders and contributors|regents and contributors) as "
     r"is and any express or implied warranties"),
    ("bsd-4-clause", 1.0,
     r"this product includes software developed by the university of california berkeley and its "
     r"contributors"),
    ("0bsd", 0.9,
     r"permission to use copy modify and or distribute this software for any purpose with or without fee is"
     r" hereby granted the software is provided as is"),
    ("isc", 0.9,
     r"with or without fee is hereby granted provided that the above copyright notice and this permission "
     r"notice appear in all copies"),
    ("zlib", 0.9,
     r"the origin of this software must not be misrepresented you must not claim that you wrote the "
     r"original software"),
    ("zlib", 0.9,
     r"altered source versions must be plainly marked as such and must not be misrepresented as being the "
     r"original software"),
    ("zlib", 0.8, r"this notice may not be removed or altered from any source distribution"),
    ("gpl-2", 0.9,
     r"gnu general public license as published by the free software foundation either version 2 of the "
     r"license"),
    ("gpl-3", 0.9,
     r"gnu general public license as published by the free software foundation either version 3 of the "
     r"license"),
    ("gpl-2", 0.9, r"gnu general public license version 2 (?:only )?as published by the free software foundation"),
    ("gpl-2", 0.9, r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", 0.9,
     r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", 0.8, r"you should have received a copy of the gnu general public license along with this program"),
    ("gpl", 0.8, r"when we speak of free software we are referring to freedom not price"),
    ("gpl-3", 0.9, r"a user product is either 1 a consumer product which means any tangible personal property"),
    ("lgpl-2.1", 0.9,
     r"gnu lesser general public license as published by the free software foundation either version 2 1 of"
     r" the license"),
    ("lgpl-3", 0.9,
     r"gnu lesser general public license as published by the free software foundation either version 3 of "
     r"the license"),
    ("lgpl-2", 0.9,
     r"gnu library general public license as published by the free software foundation either version 2 of "
     r"the license"),
    ("lgpl", 0.8,
     r"the object code form of an application may incorporate material from a header file that is part of "
     r"the library"),
    ("agpl-3", 0.9,
     r"gnu affero general public license as published by the free software foundation either version 3 of "
     r"the license"),
    ("agpl-3", 0.9,
     r"your modified version must prominently offer all users interacting with it remotely through a "
     r"computer network"),
    ("gfdl", 1.0,
     r"permission is granted to copy distribute and or modify this document under the terms of the gnu free"
     r" documentation license"),
    ("gfdl", 0.9,
     r"the purpose of this license is to make a manual textbook or other functional and useful document "
     r"free in the sense of freedom"),
    ("mpl-1.1", 1.0, r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", 0.8,
     r"you may not use this file except in compliance with the license you may obtain a copy of the license"
     r" at http www mozilla org mpl"),
    ("mpl-2", 1.0, r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2", 0.9,
     r"this source code form is incompatible with secondary licenses as defined by the mozilla public "
     r"license"),
    ("epl-1", 1.0, r"the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("epl-1", 1.0,
     r"this program and the accompanying materials are made available under the terms of the eclipse public"
     r" license v ?1 0"),
    ("epl-2", 1.0,
     r"this program and the accompanying materials are made available under the terms of the eclipse public"
     r" license (?:v ?)?2 0"),
    ("epl-2", 0.9, r"the accompanying program is provided under the terms of this eclipse public license v 2 0"),
    ("cpl-1", 1.0, r"the accompanying program is provided under the terms of this common public license agreement"),
    ("ibm-pl-1", 1.0, r"the accompanying program is provided under the terms of this ibm public license agreement"),
    ("cddl-1", 1.0,
     r"the contents of this file are subject to the terms of the common development and distribution "
     r"license"),
    ("cddl-1", 1.0, r"when distributing covered code include this cddl header in each file"),
    ("cddl-1", 0.8,
     r"covered software is provided under this license on an as is basis without warranty of any kind"),
    ("eupl-1.2", 0.9, r"licensed under the eupl version 1 2"),
    ("eupl-1.1", 0.9, r"licensed under the eupl version 1 1"),
    ("eupl-1.2", 0.9, r"the work is a work in progress which is continuously improved by numerous contributors"),
    ("boost-1", 1.0,
     r"permission is hereby granted free of charge to any person or organization obtaining a copy of the "
     r"software and accompanying documentation covered by this license"),
    ("boost-1", 1.0, r"distributed under the boost software license version 1 0"),
    ("boost-1", 0.9,
     r"unless such copies or derivative works are solely in the form of machine executable object code "
     r"generated by a source language processor"),
    ("artistic-1", 0.9,
     r"the intent of this document is to state the conditions under which a package may be copied such that"
     r" the copyright holder maintains some semblance of artistic control"),
    ("artistic-2", 0.9,
     r"this license establishes the terms under which a given free software package may be copied modified "
     r"distributed and or redistributed"),
    ("artistic-2", 0.9,
     r"you are permitted to use the standard version and create and use modified versions for any purpose "
     r"without restriction"),
    ("perl", 0.9, r"you can redistribute it and or modify it under the same terms as perl itself"),
    ("ofl-1.1", 1.0, r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", 1.0,
     r"neither the font software nor any of its individual components in original or modified versions may "
     r"be sold by itself"),
    ("ofl-1.1", 0.9,
     r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font "
     r"projects"),
    ("ofl-1.1", 0.9, r"no modified version of the font software may use the reserved font name"),
    ("postgresql", 0.9,
     r"for any purpose without fee and without a written agreement is hereby granted provided that the "
     r"above copyright notice and this paragraph and the following two paragraphs appear in all copies"),
    ("postgresql", 0.8,
     r"in no event shall the university of california be liable to any party for direct indirect special "
     r"incidental or consequential damages"),
    ("psf-2", 1.0,
     r"this license agreement is between the python software foundation psf and the individual or "
     r"organization"),
    ("psf-2", 0.9, r"psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("psf-2", 0.9, r"psf is making python available to licensee on an as is basis"),
    ("php-3", 1.0, r"the name php must not be used to endorse or promote products derived from this software"),
    ("php-3", 0.9, r"products derived from this software may not be called php nor may php appear in their name"),
    ("php-3", 0.9, r"this product includes php software freely available from"),
    ("openssl", 1.0,
     r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", 1.0,
     r"the names openssl toolkit and openssl project must not be used to endorse or promote products"),
    ("ssleay", 1.0, r"this product includes cryptographic software written by eric young"),
    ("odbl-1", 1.0,
     r"the open database license odbl is a license agreement intended to allow users to freely share modify"
     r" and use this database"),
    ("odbl-1", 0.9, r"is made available under the open database license"),
    ("dbcl-1", 0.9,
     r"any rights in individual contents of the database are licensed under the database contents license"),
    ("pddl-1", 1.0,
     r"the open data commons public domain dedication (?:and|amp) licen[cs]e is a document intended to "
     r"allow you to freely share modify and use this work"),
    ("odc-by-1", 1.0, r"is made available under the open data commons attribution license"),
    ("upl-1", 1.0,
     r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy"
     r" of this software associated documentation and or data"),
    ("afl-3", 1.0, r"licensed under the academic free license version 3 0"),
    ("afl-3", 0.9, r"this academic free license the license applies to any original work of authorship"),
    ("osl-3", 1.0, r"licensed under the open software license version 3 0"),
    ("osl-3", 0.9, r"this open software license the license applies to any original work of authorship"),
    ("ncsa", 0.9,
     r"to deal with the software without restriction including without limitation the rights to use copy "
     r"modify merge"),
    ("ncsa", 0.9,
     r"neither the names of .{1,80}? nor the names of its contributors may be used to endorse or promote "
     r"products derived from this software without specific prior written permission"),
    ("elastic-2", 1.0, r"you may not provide the software to third parties as a hosted or managed service"),
    ("elastic-2", 1.0,
     r"you may not move change disable or circumvent the license key functionality in the software"),
    ("elastic-2", 0.9,
     r"the licensor grants you a non exclusive royalty free worldwide non sublicensable non transferable "
     r"license"),
    ("bsl-1.1", 1.0,
     r"the licensor hereby grants you the right to copy modify create derivative works redistribute and "
     r"make non production use of the licensed work"),
    ("bsl-1.1", 1.0,
     r"effective on the change date or the fourth anniversary of the first publicly available distribution"),
    ("bsl-1.1", 0.9,
     r"use of the licensed work in violation of this license will automatically terminate your rights"),
    ("sspl-1", 1.0,
     r"if you make the functionality of the program or a modified version available to third parties as a "
     r"service"),
    ("sspl-1", 1.0, r"server side public license version 1 october 16 2018"),
    ("ms-pl", 0.9,
     r"this license governs use of the accompanying software if you use the software you accept this "
     r"license"),
    ("ms-pl", 0.9,
     r"each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce "
     r"its contribution"),
    ("ms-rl", 1.0,
     r"for any file you distribute that contains code from the software in source code or binary format you"
     r" must provide recipients the source code to that file"),
    ("unlicense", 1.0,
     r"anyone is free to copy modify publish use compile sell or distribute this software either in source "
     r"code form or as a compiled binary"),
    ("unlicense", 0.9,
     r"the author or authors of this software dedicate any and all copyright interest in the software to "
     r"the public domain"),
    ("wtfpl", 0.9,
     r"everyone is permitted to copy and distribute verbatim or modified copies of this license document "
     r"and changing it is allowed as long as the name is changed"),
    ("beerware", 1.0, r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("vim", 1.0, r"vim is charityware you can use and copy it as much as you like"),
    ("cc0-1", 1.0, r"has waived all copyright and related or neighboring rights to"),
    ("cc0-1", 0.9, r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", 1.0,
     r"this work is licensed under (?:a|the) creative commons attribution [1234] [05] "
     r"(?:international|unported|generic) license"),
    ("cc-by-sa", 1.0,
     r"this work is licensed under (?:a|the) creative commons attribution share ?alike [1234] [05] "
     r"(?:international|unported|generic) license"),
    ("cc-by-nd", 1.0,
     r"this work is licensed under (?:a|the) creative commons attribution no ?derivatives [1234] [05] "
     r"(?:international|unported|generic) license"),
    ("cc-by-nc", 1.0,
     r"this work is licensed under (?:a|the) creative commons attribution non ?commercial [1234] [05] "
     r"(?:international|unported|generic) license"),
    ("cc-by-nc-sa", 1.0,
     r"this work is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike "
     r"[1234] [05] (?:international|unported|generic) license"),
    ("cc-by-nc-nd", 1.0,
     r"this work is licensed under (?:a|the) creative commons attribution non ?commercial no "
     r"?deriv(?:ative)?s [1234] [05] (?:international|unported|generic) license"),
    ("w3c", 0.9,
     r"this work and or accompanying materials is being provided by the copyright holders under the "
     r"following license"),
    ("zpl-2", 0.9, r"zope public license zpl version 2 [01]"),
    ("zpl-2", 0.9,
     r"names of the copyright holders must not be used to endorse or promote products derived from this "
     r"software without prior written permission from the copyright holders"),
    ("commons-clause", 1.0,
     r"the license does not grant to you and the license does not include the right to sell the software"),
    ("commons-clause", 1.0, r"commons clause license condition v1 0"),
    ("polyform", 0.9,
     r"for any permitted purpose however you may only distribute the software according to distribution "
     r"license"),
    ("fair", 0.9, r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("curl", 0.8,
     r"except as contained in this notice the name of a copyright holder shall not be used in advertising"),
    ("libpng", 0.9, r"the png reference library is supplied as is"),
    ("ijg", 0.9, r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", 0.9, r"portions of this software are copyright .{1,40}? the freetype project"),
    ("proprietary", 0.8, r"all rights reserved no part of this (?:document|publication|book|work) may be reproduced"),
    ("proprietary", 0.8, r"this (?:software|document|file) contains (?:trade secrets|confidential information) of"),
    ("proprietary", 0.8, r"use of this software is governed by the terms of (?:the|your) license agreement with"),
)
