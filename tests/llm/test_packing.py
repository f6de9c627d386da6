import numpy as np
import pytest

from flowlake.llm import packing


@pytest.mark.parametrize("numbers", [[], [0], [5], [0, 1, 127, 128, 16384, 2097152, 1 << 33, (1 << 62) + 5]])
def test_round_trip(numbers):
    content, ends = packing.pack(np.array(numbers, np.int64))
    assert packing.unpack(content.tobytes()).tolist() == numbers
    assert len(ends) == len(numbers) and (not numbers or ends[-1] == len(content))
    assert packing.unpack_sorted(packing.pack_sorted(np.array(numbers, np.int64))).tolist() == numbers


def test_lists_after_each_other():
    numbers, starts = np.array([3, 9, 9, 1, 200]), np.array([0, 3])
    content, ends = packing.pack(packing.gaps(numbers, starts))
    cut = np.concatenate([[0], ends])[3]
    assert packing.unpack_sorted(content[:cut].tobytes()).tolist() == [3, 9, 9]
    assert packing.unpack_sorted(content[cut:].tobytes()).tolist() == [1, 200]
