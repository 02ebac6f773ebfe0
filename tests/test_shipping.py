"""Functions sent to Python workers must not need the package there."""

import subprocess
import sys

import pyarrow as pa
from pyspark import cloudpickle

from weekgrid.operators import affinity, timeseries


def test_worker_functions_carry_their_code(tmp_path):
    batch = pa.RecordBatch.from_pydict(
        {"store": [1, 1, 1], "date": [4, 4, 5], "dept": [1, 2, 2], "residual_sales": [2.0, 3.0, 5.0]}
    )
    data = (affinity._cross_products, timeseries._fit, batch)
    (tmp_path / "call.pkl").write_bytes(cloudpickle.dumps(data))
    code = (
        "import importlib.util, pickle, numpy as np\n"
        "assert importlib.util.find_spec('weekgrid') is None\n"
        "products, fit, batch = pickle.load(open('call.pkl', 'rb'))\n"
        "out = list(products([batch]))\n"
        "assert out[0].to_pydict() == {'a': [1], 'b': [2], 'sxy': [6.0]}, out\n"
        "assert fit(np.arange(30) % 7.0, 1, 1)[2] == 28\n"
    )
    done = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
