"""Made-up prose for the tests of the training-data operators."""

WORDS = ("river stone cloud amber forest candle window marble garden silver copper velvet harbor meadow lantern "
         "thunder pepper basket saddle mirror hollow timber ribbon pocket walnut kettle anchor feather island tunnel").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))
