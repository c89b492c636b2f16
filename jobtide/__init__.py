"""jobtide: job-posting analytics written as Spark DataFrame functions.

Every public function takes DataFrames (or a session and paths) and returns a
DataFrame.  Nothing here keeps a global session.
"""
