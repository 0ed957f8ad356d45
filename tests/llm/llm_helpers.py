import random


def words(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]
