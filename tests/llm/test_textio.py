import numpy as np

from gable.llm.textio import chunks


def lowered(texts):
    return [bytes(c.lowered()[a:b]).decode() for c in chunks([t.encode() for t in texts]) for a, b in zip(c.begins, c.ends)]


def test_lower_case_keeps_every_character_in_its_place():
    # One letter grows by a byte and another shrinks by one: the chunk keeps its length, the texts between would shift.
    texts = ["AÄ İ B", "ÄB cD Éß", "X ẞ Y", "Plain ASCII", "", "ΑΒΓ Ω", "K K"]
    found = lowered(texts)
    assert found == [lowered([t])[0] for t in texts]
    assert [len(a.encode()) for a in found] == [len(t.encode()) for t in texts]
    assert found[0] == "aä İ b" and found[1] == "äb cd éß" and found[3] == "plain ascii"
    assert np.array_equal([len(a) for a in found], [len(t) for t in texts])
