from tiergrain.plans import metadata


def test_every_dataset_is_described():
    assert len(metadata.DATASETS) == 28
    assert {i.layer for i in metadata.DATASETS.values()} == {"bronze", "silver", "quarantine", "gold"}
    assert all(i.comment for i in metadata.DATASETS.values())
