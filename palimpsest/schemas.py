"""Schemas of the loaded tables and of a dump page, and the caps of their text columns, in one place."""

from __future__ import annotations

COMMENT_CAP = 800
REDIRECT_CAP = 510
RESULT_CAP = 1024

TABLES = {
    "user": "user_id long, user_name string",
    "namespace": "namespace_id int, namespace_name string",
    "page": "namespace_id int, page_id long, page_name string, redirect_title string",
    "page_revision": (
        "namespace_id int, page_id long, page_revision_id long, parent_page_revision_id long, revision_when timestamp, contributor_id long, "
        "ip_address string, comment string, text_available boolean, is_minor boolean, article_text_length int, text_deleted boolean, "
        "user_deleted boolean"
    ),
    "page_revision_text": "namespace_id int, page_id long, page_revision_id long, article_text string",
    "run": (
        "run_id long, host_name string, proc_id long, source_file_name string, source_file_size long, source_file_timestamp timestamp, "
        "start_time timestamp, end_time timestamp, result string"
    ),
    "run_progress": "run_id long, report_time timestamp, file_position long, page_id long",
    "activity": (
        "run_id long, activity_id long, thread_id long, activity string, start_time timestamp, target_namespace int, target_page_id long, "
        "work_count long, completed_count long, end_time timestamp, duration_millis long, result string"
    ),
}

DUMP_PAGE = (
    "title string, ns int, id bigint, redirect struct<_title:string>, "
    "revision array<struct<id:bigint, parentid:bigint, timestamp:timestamp, "
    "contributor:struct<_selfclosed:int, _deleted:string, username:string, id:bigint, ip:string>, minor:string, "
    "comment:struct<_selfclosed:int, _deleted:string, _VALUE:string>, "
    "text:struct<_selfclosed:int, _bytes:bigint, _deleted:string, _VALUE:string>>>"
)
DUMP_NAMESPACE = "_key int, _VALUE string"
