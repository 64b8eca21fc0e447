import pytest

from cellpulse.llm import license_scan

GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 * 1. Redistributions of source code must retain the above copyright notice."""
MIT = """Permission is hereby granted, free of charge,
to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal"""


@pytest.fixture(scope="module")
def model(docs):
    return license_scan.fit(docs, sample=40)


@pytest.mark.parametrize("notice, family", [(GPL, "gpl"), (BSD, "bsd"), (MIT, "mit")])
def test_wrapped_notices_are_found(model, notice, family):
    prose = "a line of other words\n" * 30
    for text, line in ((notice, 0), ("one\n\n" + notice + "\n\ntwo", 2),
                       (prose + notice + "\n" + prose, 30),
                       (prose.replace("\n", " ") + notice.replace("\n", " ") + " " + prose, 0)):
        total, found = model.notices(text)
        assert [(n, f) for n, f, _ in found] == [(line, family)], text
    assert model.notices("one\ntwo\n \n\nthree") == (2, [])


def test_blank_lines_part_paragraphs(model):
    assert model.notices(BSD.replace("\n", "\n\n"))[1] == []
    twice = model.notices(GPL + "\n\n" + MIT)[1]
    assert [(n, f) for n, f, _ in twice] == [(0, "gpl"), (5, "mit")]
