"""Expectation-maximisation over votes that are yes, no or abstain, on a table of vote patterns.

The model: an item is good with a prior probability (one for each group), and a voter that votes
yes, or no, is right with a probability of its own for that vote; whether it votes says nothing.
So a single rule that flags many items which nothing else speaks against loses weight, and rules
that flag the same items confirm each other. The input is one row per distinct (group, votes) with
its count, which Spark has summed up: at most groups x 3^voters rows, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Votes in pattern strings: yes, no, abstain.
YES, NO, ABSTAIN = "y", "n", "-"


@dataclass
class Reliability:
    prior: dict            # group -> probability of good
    right: np.ndarray      # [voter, yes or no] -> probability that the vote is right

    def log_odds(self) -> np.ndarray:
        """[voter, yes or no] -> what the vote adds to the log-odds of good."""
        return np.log(self.right / (1 - self.right)) * np.array([1, -1])

    def posterior(self, group, votes: str) -> float:
        p, gain = self.prior[group], self.log_odds()
        odds = np.log(p / (1 - p)) + sum(gain[j, int(v == NO)] for j, v in enumerate(votes) if v != ABSTAIN)
        return float(1 / (1 + np.exp(-np.clip(odds, -700, 700))))


def fit(patterns: list[tuple], voters: int, prior: float = 0.5, trust: float = 0.85, rounds: int = 200,
        smooth: float = 2.0, learn_prior: bool = True) -> Reliability:
    """``patterns`` of (group, votes, count). It starts from voters that are right with probability
    ``trust``, which also fixes which class is called good; an empty table gives that start. With
    ``learn_prior`` off the prior is a given class balance."""
    groups = sorted({g for g, _, _ in patterns}, key=str)
    right = np.full((voters, 2), trust)
    if not patterns:
        return Reliability({}, right)
    at = {g: i for i, g in enumerate(groups)}
    group = np.array([at[g] for g, _, _ in patterns])
    cast = np.array([[[v == YES, v == NO] for v in p] for _, p, _ in patterns], float)  # pattern, voter, vote
    count = np.array([n for _, _, n in patterns], float)
    priors, total = np.full(len(groups), prior), np.bincount(group, count, len(groups))
    sign = np.array([1, -1])
    votes = np.einsum("p,pvk->vk", count, cast)
    for _ in range(rounds):
        odds = np.log(priors / (1 - priors))[group] + np.einsum("pvk,vk->p", cast, np.log(right / (1 - right)) * sign)
        good = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        agree = np.stack([np.einsum("p,pv->v", count * good, cast[:, :, 0]),
                          np.einsum("p,pv->v", count * (1 - good), cast[:, :, 1])], 1)
        new = np.clip((agree + smooth * trust) / (votes + smooth), 0.02, 0.9999)
        if learn_prior:
            priors = np.clip((np.bincount(group, count * good, len(groups)) + smooth * prior) / (total + smooth), 1e-4, 1 - 1e-4)
        moved = np.abs(new - right).max()
        right = new
        if moved < 1e-7:
            break
    return Reliability(dict(zip(groups, priors.tolist())), right)
