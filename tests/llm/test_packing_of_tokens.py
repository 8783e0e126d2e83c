"""Token ids against the tokenizer's own file."""

import random

import pytest
from hypothesis import given, settings, strategies as st

from barloom.llm import packing
from barloom.llm.catalog import byte_bpe

PARTS = ["a", "B", "é", " ", "  ", "\n", "\t", "\r", "'s", "'", "1", "23", "!", "…", " ", " ", "​", "中", "🙂",
         "\x00", "\x1c", "\x85", "don't", "'LL", "ſ", "½", "Ⅷ", "﻿", "x" * 40, "<|endoftext|>", " " * 20_000]


@pytest.fixture(scope="module")
def encoder():
    return packing.encoder(*byte_bpe())


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=12))
def test_ids_are_the_tokenizers_own(encoder, parts):
    text = "".join(parts)
    assert encoder.ids(text) == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def best_fit(sizes):
    return packing.best_fit(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sizes, [])


@pytest.mark.parametrize("bins", [40, 100, 300])
def test_evolution_beats_best_fit_where_it_can(bins):
    """Triplets that fill ``bins`` bins exactly, while best fit from the largest on needs a sixth more."""
    rng = random.Random(bins)
    sizes = []
    for _ in range(bins):
        a = rng.randint(390, 500)
        b = rng.randint(260, (1024 - a) // 2)
        sizes += [a, b, 1024 - a - b]
    rng.shuffle(sizes)
    seed, found = best_fit(sizes), packing.evolve(sizes, [], 1)
    assert len(seed) >= 1.12 * bins and len(found) <= 1.04 * bins
    assert sorted(i for b in found for i in b) == list(range(len(sizes)))
    assert max(sum(sizes[i] for i in b) for b in found) <= 1024


def test_crossover_improves_on_both_parents():
    """From two poor parents, generations alone lead to fewer bins than either has."""
    rng = random.Random(3)
    sizes = [rng.choice([341, 342, 500, 170, 100, 270]) for _ in range(400)]
    parents = [packing.best_fit(rng.sample(range(400), 400), sizes, []) for _ in range(4)]
    found = packing.evolve(sizes, parents, 1)
    assert len(found) < min(map(len, parents))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1024), min_size=1, max_size=60))
def test_refilled_bins_hold_each_item_once(sizes):
    bins = packing.refill(list(range(len(sizes))), sizes, [])
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 1024 for b in bins)
