"""The table of labelled addresses: no stored host in it, and hosts of words it lacks."""

from selvatrace.llm import urls


def test_table_names_no_stored_host():
    names = {n for host, _, _ in urls.labelled() for n in host.split(".")}
    assert not names & {"casino-win", "free-bets", "cheap-pills", "ads-track", "spam-farm", "adult-x", "thering", "therti", "ththan", "tiontion"}


def test_hosts_of_unseen_words():
    """Every fifth word is left out of the table; hosts made of those words only are judged."""
    right = {0: [0, 0], 1: [0, 0]}
    for fold in range(5):
        seen, unseen = ({k: [w for i, w in enumerate(v) if (i % 5 == fold) == out] for k, v in urls.WORDS.items()} for out in (False, True))
        weights = urls.train(urls.labelled(seen))
        for host, path, label in urls.labelled(unseen):
            at = urls.features(host, path)
            right[label][0] += int((weights[at].sum() / len(at) ** 0.5 + weights[-1] >= 0) == label)
            right[label][1] += 1
    assert right == {0: [162, 236], 1: [70, 200]}  # as the README says: the model knows words, not their kind
