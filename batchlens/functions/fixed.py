"""Markup of graph labels, task names and texts of event-log rows.

They must equal what readers of these graphs and logs expect, so they are stated
once, as text; the jobs and the SQL that they are compared with both use them.
"""

# --- labels of both graphs
TABLE_OPEN = '<table border="1" cellspacing="0" cellpadding="5" cellborder="0">'
LABEL_OPEN = f" [label=<{TABLE_OPEN}"
LABEL_CLOSE = "</table>>];"
CELL_CLOSE = "</td></tr>"
NAME_CLOSE = "</b></td></tr>"
DURATION, MINUTES = "Average Duration-", " min"

# --- declared sequence
SEQ_MART_CELL = {"Source": '<td bgcolor="#cee2ffff">', "Subject Area": '<td bgcolor="#a487b7">'}
SEQ_MART_CELL_BROKEN = '<td bgcolor="#cfcfcfed" data-cell-info="Broken References">'
SEQ_BATCH_CELL_OK = '<tr><td bgcolor="#ffffff">'
SEQ_BATCH_CELL_BROKEN = '<tr><td bgcolor="#ffb255ed" data-cell-info="Broken References">'
SEQ_FINISHED = '<tr><td bgcolor="#69b660ff">Finished at '
SEQ_RUNNING = '<tr><td bgcolor="#2a77bb">In Progress</td></tr>'
SEQ_LAST_RUN, SEQ_NEXT_RUN = "<tr><td>Last Run: ", "<tr><td>Next Run: "
DID_NOT_RUN = '<tr><td bgcolor="#FF0000" style="color: #ffffff">Did not run today</td></tr>'
NOT_SCHEDULED_TODAY = '<tr><td bgcolor="#aeaeae" style="color: #ffffff">Not Scheduled Today</td></tr>'
EDGE_ACTIVE = 'target="_blank" rel="noopener noreferrer" style="solid"'
EDGE_INACTIVE = 'style="dashed" color="#5E676F"'

# --- derived graph
DERIVED_MART_CELL = {"Source": '<td bgcolor="#fffece">', "Subject Area": '<td bgcolor="#ffdb99">',
                     "IDEA": '<td bgcolor="#DDA0DD">'}
DERIVED_MART_CELL_OTHER = '<td bgcolor="#F13C45">'
DERIVED_BATCH_CELL, DERIVED_BATCH_CELL_NONE = '<tr><td bgcolor="#FFFFFF">', '<tr><td bgcolor="#F13C45">'
DERIVED_FINISHED, DERIVED_IDEA = '<td bgcolor="#c3e5d3">Finished at ', '<td bgcolor="#c3e5d3">'
DERIVED_LAST_RUN, DERIVED_LATE = "Last Run ", '<td bgcolor="#FF0000">Did not run today'
NO_BATCH = "No Batch is created"
IDEA_NO_BATCH = "IDEA Source - Batch is not needed"

# --- event log
PURGE_PACKAGE = "PurgeHistoricalSnapshotData"
PURGE_PROCEDURE = "SAM.ClientAdmin.etlPurgeHistoricalSnapshotData"
VALIDATE_PACKAGE = "ValidateSnapshotData"
VALIDATE_PROCEDURE = "SAM.ClientAdmin.etlValidateSnapshotData"
PURGE_TASKS = {"start": "Process Start", "table": "Table Processing Start", "cutoff": "Cutoff Date Calculation",
               "enabled": "Purge Enabled", "delete": "DELETE Statement", "done": "Process Complete"}
PURGE_TEXTS = {"start": "Starting Purge Process - ", "table": "Processing Table: ", "flag": " | PurgeDataFLG: ",
               "field": " | PurgeDateFieldNM: ", "days": " | PurgeLookbackDaysNBR: ", "cutoff": "Cutoff Date Calculated: ",
               "enabled": "PURGE ENABLED - Starting deletion process for ", "disabled": "PURGE DISABLED - Reasons: ",
               "none": " No deletes executed for ", "preview": ". Delete statement preview only.",
               "deleted": " records deleted from ", "using": " using cutoff date ", "done": "Purge Process Complete - "}
VALIDATE_TASKS = {"table": "Table Processing Start", "check": "Validation Check", "status": "Validation Status",
                  "done": "End of Stored Proc"}
VALIDATE_TEXTS = {"table": "Current Entity: ", "start": "Starting snapshot validation for ", "rows": "Rows loaded today: ",
                  "failed": "Validation FAILED. Data already exists today in   -->   ",
                  "passed": "Validation PASSED. Data has not been loaded today in   -->   ",
                  "skipped": "Validation skipped (ValidateSnapshotFLG = 0)",
                  "unknown": "Validation skipped (unknown SnapshotPeriodCD)",
                  "done": "Snapshot Validation Script Complete"}
