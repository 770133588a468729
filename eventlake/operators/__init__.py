"""Row-wise operators: each takes and returns a DataFrame, batch or streaming alike."""
