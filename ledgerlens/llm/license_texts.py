"""Phrases and openings of public licence texts, as text.

Each entry: label, words of the text (lower case, as the operator splits words),
phrases that must stand in a file for the label to be given.
"""

#: The base phrases and their labels.
BASE_PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]

#: Label, opening of the licence or its notice, mandatory key phrases.
TEMPLATES = [
    ("mit",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("apache",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
     ["licensed under the apache license", "in compliance with the license"]),
    ("gpl",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
     ["is free software", "gnu general public license"]),
    ("lgpl",
     "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
     ["is free software", "gnu lesser general public license"]),
    ("agpl",
     "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
     ["gnu affero general public license"]),
    ("bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ["redistribution and use in source and binary forms"]),
    ("mpl",
     "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
     ["mozilla public license"]),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
     ["permission to use copy modify and or distribute this software", "with or without fee"]),
    ("unlicense",
     "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
    ("cc-by",
     "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution"]),
]
