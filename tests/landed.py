"""What several test modules use; a name of its own, as every folder of tests has a ``conftest``."""

import os

SMALL = "/root/testdata/sf0.001"


def data_files(path):
    """Paths of the data files below a local folder."""
    found = []
    for folder, _, names in os.walk(path):
        found += [os.path.join(folder, n) for n in names if not n.startswith((".", "_"))]
    return sorted(found)
