"""DataFrame to DataFrame operators. None reads or writes, and none but model fitting starts a job."""
